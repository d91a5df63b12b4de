import pytest

from feedloom.llm import licenses
from feedloom.llm.licenses import compile_template, matched, words_of


def hit(template, text):
    words = words_of(text.encode())
    return matched(compile_template("t", template), words, b" " + b" ".join(words) + b" ")


def test_optional_and_replaceable_regions():
    t = "Licensed under [[the terms of]] the Foo License version <<v:1|2>> [[only]] by <<who:1-3>> always"
    assert hit(t, "x Licensed under the Foo License, Version 2 by Ann always.")
    assert hit(t, "LICENSED under the terms of the foo license version 1 only by a b c always")
    assert not hit(t, "licensed under the foo license version 3 by ann always")
    assert not hit(t, "licensed under the foo license version 2 by a b c d always")
    assert not hit(t, "licensed under the foo big license version 2 by ann always")
    assert not hit(t, "licensed under the terms the foo license version 2 by ann always")


def test_nested_optional_region_and_start_before_the_key():
    t = "[[a [[very]] big]] word stands here for all to see"
    for text in ("word stands here for all to see", "a big word stands here for all to see", "a very big word stands here for all to see"):
        assert hit(t, text)


def test_unclosed_template_is_refused():
    with pytest.raises(ValueError):
        compile_template("t", "a [[ b")


def test_rows(documents):
    long = "lorem " * 200_000 + "Released under the MIT License."
    rows = [
        (1, None), (2, ""), (3, "... !"), (4, "MIT License mit LICENSE"), (5, "Licensed under the Apache License, Version 2.0."),
        (6, "This work is licensed under the GNU General Public License, version 3."), (7, long), (7, long),
        (8, "Licensed under CC BY-NC 4.0."), (None, "É mit license"), (9, "summit license mit license"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan(documents(rows)).collect()}
    assert (got[1]["n_words"], got[1]["n_base"], got[1]["first_word"], got[1]["labels"], got[1]["score"]) == (0, 0, None, "", 0.0)
    assert got[3]["n_words"] == 0
    assert (got[4]["n_base"], got[4]["first_word"], got[4]["last_word"], got[4]["labels"], got[4]["score"]) == (2, 0, 2, "mit", 0.5)
    assert got[5]["labels"] == "apache,apache-2.0-notice" and got[5]["base_labels"] == "apache" and got[5]["score"] == 1.0
    assert got[6]["labels"] == "gpl,gpl-notice"
    assert got[7]["first_word"] == 200_003 and got[7]["labels"] == "mit,mit-notice"
    assert got[8]["labels"] == "cc-by-nc-4.0-notice" and got[8]["base_labels"] == ""
    assert got[None]["n_base"] == 1
    assert got[9]["n_base"] == 0
    assert licenses.scan(documents(rows)).count() == len(rows)


def test_whole_texts_match_their_templates():
    for label, template in licenses.TEMPLATES.items():
        plain = template.replace("[[", " ").replace("]]", " ")
        plain = __import__("re").sub(r"<<\w+:(\d+)-\d+>>", "some", plain)
        plain = __import__("re").sub(r"<<\w+:([^|>]+)[^>]*>>", r"\1", plain)
        assert hit(template, plain), label


def test_empty_table(documents):
    assert licenses.scan(documents([])).count() == 0


def test_cut_and_changed_texts_are_partial(documents):
    mit = licenses._MIT.replace("[[including the next paragraph]] ", "")
    end = licenses._MIT_WARRANTY.replace("[[NON]] <<what:noninfringement|infringement>>", "NONINFRINGEMENT")
    end = end.replace("<<who:1-12>>", "THE AUTHORS OR COPYRIGHT HOLDERS")
    x11 = " Except as contained in this notice, the name of X shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from X."
    texts = [mit, f"{mit}. {end}.", f"{mit}. The Software shall be used for Good, not Evil. {end}", f"{mit} {end} {x11}", f"{mit} and more {end}", licenses._ISC]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(documents(list(enumerate(texts)))).collect()}
    assert got == {0: ("mit-text-partial", 0.5), 1: ("mit-text", 1.0), 2: ("json-text", 1.0), 3: ("x11-text", 1.0),
                   4: ("mit-text-partial", 0.5), 5: ("isc-text-partial", 0.5)}
