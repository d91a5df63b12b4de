"""License scans: word templates with optional and replaceable regions, compiled to token automata.

A template is plain wording with two kinds of markup. ``[[ ... ]]`` encloses an optional region and
may be nested; ``<<name:least-most>>`` stands for so many words of any kind, ``<<name:a|b|c>>`` for one
of the words listed. Everything else is mandatory and must match word by word. Case, punctuation and
line breaks never matter, because texts and templates are compared as words.

A template is looked for only where its key stands, the longest run of mandatory words on its
outermost level. From there every possible start is tried with the automaton, a set of states that
advances word by word; the template matches where a final state is reached.

Defined results: a null or empty text has no words, no places, empty label lists and score 0;
repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_MIT = (
    "Permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the Software to deal in the Software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the Software and to permit persons to whom the Software is furnished to do so subject to "
    "the following conditions The above copyright notice and this permission notice [[including the next "
    "paragraph]] shall be included in all copies or substantial portions of the Software"
)
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS WITHOUT WARRANTY OF ANY KIND EXPRESS OR IMPLIED INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY FITNESS FOR A PARTICULAR PURPOSE AND [[NON]] <<what:noninfringement|infringement>> "
    "IN NO EVENT SHALL <<who:1-12>> BE LIABLE FOR ANY CLAIM DAMAGES OR OTHER LIABILITY WHETHER IN AN ACTION OF CONTRACT "
    "TORT OR OTHERWISE ARISING FROM OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"
)
_ISC = (
    "Permission to use copy modify and or distribute this software for any purpose with or without fee "
    "is hereby granted provided that the above copyright notice and this permission notice appear in all copies"
)
_APACHE = (
    "you may not use this <<what:file|work|software>> except in compliance with the License "
    "You may obtain a copy of the License at <<url:1-12>> Unless required by applicable law or "
    "agreed to in writing software distributed under the License is distributed on an AS IS BASIS "
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND either express or implied"
)
_BSD = (
    "Redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met [[<<n:1|a>>]] Redistributions of source code must retain the above copyright notice "
    "this list of conditions and the following disclaimer [[<<n:2|b>>]] Redistributions in binary form must reproduce "
    "the above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution"
)
_BSD_NAMES = (
    "[[<<n:3|c>>]] Neither the name of <<who:1-12>> nor the names of <<its:1-4>> may be used to endorse or promote "
    "products derived from this software without specific prior written permission"
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY <<who:1-12>> AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES INCLUDING BUT NOT LIMITED TO "
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED IN NO EVENT SHALL "
    "<<who:1-12>> BE LIABLE FOR ANY DIRECT INDIRECT INCIDENTAL SPECIAL EXEMPLARY OR CONSEQUENTIAL DAMAGES INCLUDING BUT "
    "NOT LIMITED TO PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES LOSS OF USE DATA OR PROFITS OR BUSINESS INTERRUPTION "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY WHETHER IN CONTRACT STRICT LIABILITY OR TORT INCLUDING NEGLIGENCE OR "
    "OTHERWISE ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)

# Wording of public licenses to their last mandatory word, and of the usual notices that
# point to them.
TEMPLATES = {
    "apache-2.0-notice": "Licensed under [[the terms of]] the Apache [[Software]] License Version <<v:2>> [[<<minor:0>>]]",
    "apache-2.0-header": f"{_APACHE} See the License for the specific language governing permissions and limitations under the License",
    "agpl-notice": (
        "redistribute it and or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation"
    ),
    "bsd-2-clause-text": f"{_BSD} {_BSD_WARRANTY}",
    "bsd-3-clause-text": f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}",
    "cc-by-nc-4.0-notice": (
        "Licensed under [[a]] [[the]] [[Creative Commons]] <<name:cc|attribution>> [[by]] "
        "<<nc:nc|noncommercial>> <<v:4>> [[<<minor:0>>]] [[International]] [[License]]"
    ),
    "gpl-notice": (
        "<<what:program|work|software|project|library|file>> is [[free software]] [[released]] licensed under "
        "[[the terms of]] the GNU General Public License [[as published by the Free Software Foundation]] "
        "[[either]] [[version <<v:1|2|3>> [[<<minor:0>>]] [[of the License]] [[or at your option any later version]]]]"
    ),
    "isc-text": (
        f"{_ISC} THE SOFTWARE IS PROVIDED AS IS AND <<who:1-12>> <<verb:disclaims|disclaim>> ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS IN NO EVENT SHALL <<who:1-12>> "
        "BE LIABLE FOR ANY SPECIAL DIRECT INDIRECT OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
        "LOSS OF USE DATA OR PROFITS WHETHER IN AN ACTION OF CONTRACT NEGLIGENCE OR OTHER TORTIOUS ACTION ARISING OUT "
        "OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"
    ),
    "json-text": f"{_MIT} The Software shall be used for Good not Evil {_MIT_WARRANTY}",
    "lgpl-notice": (
        "redistribute it and or modify it under the terms of the GNU <<kind:lesser|library>> General Public License "
        "as published by the Free Software Foundation"
    ),
    "mit-notice": "<<verb:released|licensed|distributed|available>> under [[the terms of]] the MIT License",
    "mit-text": f"{_MIT} {_MIT_WARRANTY}",
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0 If a copy of the MPL was not "
        "distributed with this file You can obtain one at"
    ),
    "x11-text": (
        f"{_MIT} {_MIT_WARRANTY} Except as contained in this notice the name of <<who:1-12>> shall not be used in "
        "advertising or otherwise to promote the sale use or other dealings in this Software without prior written "
        "authorization from"
    ),
}

# Beginnings of these texts, named as partial where no whole text with that beginning stands.
PARTIAL = {
    "apache-2.0-header-partial": (_APACHE, {"apache-2.0-header"}),
    "bsd-text-partial": (_BSD, {"bsd-2-clause-text", "bsd-3-clause-text"}),
    "isc-text-partial": (_ISC, {"isc-text"}),
    "mit-text-partial": (_MIT, {"json-text", "mit-text", "x11-text"}),
}

# ASCII characters that end a word once A-Z is lower-cased.
_ENDS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
_TO_SPACE = bytes.maketrans(_ENDS, b" " * len(_ENDS))
_MARKS = re.compile(r"\[\[|\]\]|<<\w+:[^>]+>>|[^\s\[\]<>]+")


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: A-Z lower-cased, cut at every ASCII character that is no letter or digit."""
    return text.lower().translate(_TO_SPACE).split()


@dataclass(eq=False)
class Automaton:
    """States are numbers; ``steps[s]`` are (words or None for any, next state), ``free[s]`` next
    states that take no word. The last state accepts."""

    label: str
    steps: list[list[tuple[frozenset[bytes] | None, int]]] = field(default_factory=lambda: [[]])
    free: list[list[int]] = field(default_factory=lambda: [[]])
    key: bytes = b""
    least_before: int = 0
    most_before: int = 0

    def new_state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def closure(self, states: set[int]) -> set[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return seen

    def accepts(self, words: list[bytes], start: int) -> bool:
        """True if the template matches from ``start`` on; what follows it is of no interest."""
        final, states = len(self.steps) - 1, self.closure({0})
        while final not in states:
            if start >= len(words) or not states:
                return False
            word = words[start]
            states = self.closure({t for s in states for w, t in self.steps[s] if w is None or word in w})
            start += 1
        return True


def compile_template(label: str, template: str) -> Automaton:
    a, opened = Automaton(label), []
    state, least, most = 0, 0, 0
    runs: list[tuple[list[bytes], int, int]] = []  # mandatory runs with the words that may stand before
    broken = True
    for mark in _MARKS.findall(template):
        if mark == "[[":
            opened.append((state, most))
            broken = True
        elif mark == "]]":
            begin, _ = opened.pop()
            end = a.new_state()
            a.free[state].append(end)
            a.free[begin].append(end)
            state, broken = end, True
        elif mark.startswith("<<"):
            what = mark[2:-2].split(":")[1]
            span = re.fullmatch(r"(\d+)-(\d+)", what)
            low, high = (int(span[1]), int(span[2])) if span else (1, 1)
            allowed = None if span else frozenset(w.encode() for w in what.lower().split("|"))
            leave = []
            for k in range(high):
                if k >= low:
                    leave.append(state)
                after = a.new_state()
                a.steps[state].append((allowed, after))
                state = after
            for s in leave:
                a.free[s].append(state)
            least, most, broken = least + (0 if opened else low), most + high, True
        else:
            for word in words_of(mark.encode()):
                after = a.new_state()
                a.steps[state].append((frozenset([word]), after))
                state = after
                if not opened:
                    if broken:
                        runs.append(([], least, most))
                    runs[-1][0].append(word)
                    least, broken = least + 1, False
                most += 1
    if opened or not runs:
        raise ValueError(f"template {label} is not closed or has no mandatory words")
    # The accepting state is the last one and has no way on.
    end = a.new_state()
    a.free[state].append(end)
    words, a.least_before, a.most_before = max(runs, key=lambda r: sum(map(len, r[0])))
    a.key = b" " + b" ".join(words) + b" "
    return a


def places(joined: bytes, phrase: bytes) -> Iterator[int]:
    """Word numbers at which a phrase stands. Both are words joined, led and closed by one space."""
    at, word, counted = joined.find(phrase), 0, 0
    while at >= 0:
        word += joined.count(b" ", counted, at)
        counted = at
        yield word
        at = joined.find(phrase, at + 1)


def matched(automaton: Automaton, words: list[bytes], joined: bytes) -> bool:
    for key in places(joined, automaton.key):
        for start in range(max(0, key - automaton.most_before), key - automaton.least_before + 1):
            if automaton.accepts(words, start):
                return True
    return False


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """Per row the words, the places of the phrases and the labels of phrases and templates.

    ``score`` is 1 where a template matches, 0.5 where only a phrase or the beginning of a text stands,
    else 0. Beginnings go with the templates of this module, not with given ones.
    """
    asked = {b" " + b" ".join(words_of(p.encode())) + b" ": label for p, label in (phrases or PHRASES).items()}
    wanted = dict(templates or TEMPLATES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [compile_template(label, t) for label, t in wanted.items()]
        begun = {} if templates else {compile_template(label, t): whole for label, (t, whole) in PARTIAL.items()}
        for batch in batches:
            out = [one(t, automata, begun) for t in batch.column(1).to_pylist()]
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            arrays = [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=NAMES)

    def one(value: bytes | None, automata: list[Automaton], begun: dict[Automaton, set[str]]):
        words = words_of(value or b"")
        joined = b" " + b" ".join(words) + b" "
        base: dict[str, list[int]] = {}
        for phrase, label in asked.items():
            if found := list(places(joined, phrase)):
                base.setdefault(label, []).extend(found)
        starts = [s for found in base.values() for s in found]
        more = {a.label for a in automata if a.key in joined and matched(a, words, joined)}
        if "x11-text" in more:
            more.discard("mit-text")  # its wording is part of the other
        part = {a.label for a, whole in begun.items() if not whole & more and a.key in joined and matched(a, words, joined)}
        return (
            len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(more.union(part, base))),
            1.0 if more else 0.5 if base or part else 0.0,
        )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(run, SCHEMA)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
