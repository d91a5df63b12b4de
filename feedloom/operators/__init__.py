"""Row, column, gate, quality and merge operators."""
