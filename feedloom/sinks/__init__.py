"""Writers: tables, logs, rejected rows."""
