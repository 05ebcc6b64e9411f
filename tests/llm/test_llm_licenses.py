import pytest

from ludex.llm import licenses as li


@pytest.mark.parametrize("name,wording", li.TEMPLATES)
def test_each_template_is_found(name, wording):
    scanner = li.Scanner()
    assert scanner.judge(wording)[0] == name
    assert scanner.judge("// " + wording.upper().replace(" ", "\n * ", 3))[0] == name


def test_differences():
    scanner = li.Scanner()
    long_ = dict((n, w) for n, w in li.TEMPLATES if len(w) > 200)
    changed = long_["MIT"].replace("substantial portions", "large portions")
    name, gain, rank, notes = scanner.judge(changed)
    assert (name, rank, notes) == ("MIT", 1, ["-substantial+large"]) and gain > 0.5
    for near in ("Licensed under the Apache License, Version 1.1.", "Licensed under CC BY-NC-SA 4.0.",
                 "This work is licensed under the GNU General Public License, version 4.",
                 "This work is not licensed under the GNU General Public License, version 3.",
                 "All licences are at the back of the book, without warranty."):
        assert scanner.judge(near)[0] == "unknown", near


def test_documents(spark, edge_docs, edge_rows, no_docs, make_docs):
    assert li.license_scan(edge_docs).count() == len(edge_rows)
    assert li.license_scan(no_docs).count() == 0
    out = {r["doc_id"]: r["findings"] for r in li.license_scan(make_docs([
        (1, "Prose here.\nReleased under the MIT License.\n\n\n\n\nLicensed under CC BY-NC 4.0."),
        (2, "x " * 5000 + "Released under the MIT License."), (3, "a licence of some kind")]))
        .collect()}
    assert [(f["license"], f["first_line"]) for f in out[1]] == [("MIT", 1), ("CC-BY-NC-4.0", 6)]
    assert len(out[2]) == 1 and out[3][0]["license"] == "unknown"


def test_fixture(spark, sf_small):
    lines = {w: n for n, w in li.TEMPLATES}
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    for r in li.op1_license_scan(spark, sf_small).collect():
        want = {lines[x] for x in texts[r["doc_id"]].split("\n") if x in lines}
        assert set(filter(None, r["licenses"].split(","))) == want


def wrapped(text, width, prefix=""):
    import textwrap
    return "\n".join(prefix + x for x in textwrap.wrap(text, width, break_on_hyphens=False,
                                                       break_long_words=False))


@pytest.mark.parametrize("name,wording", li.TEMPLATES)
def test_wrapped_and_long_lines(name, wording):
    scanner = li.Scanner()
    prose = "some words of prose in which nothing is said about it "
    for text in [wrapped(wording, w, p) for w in (12, 40, 72) for p in ("", " * ", "# ")]:
        assert [f[2] for f in scanner.scan(f"{prose}.\n{text}\n{prose}")] == [name], text
        assert name in [scanner.judge(b)[0] for *_, b in li.candidate_blocks(text)], text
    for n in range(1200 - len(wording), 1203, 7):  # one line, notice around character 1200
        assert [f[2] for f in scanner.scan((prose * 40)[:n] + ". " + wording)] == [name], n


def test_list_numbers():
    bsd = dict((n, w) for n, w in li.TEMPLATES if len(w) > 200)["BSD-2-Clause"]
    a, b, c = bsd.replace("Redistributions", "\nRedistributions").split("\n")
    text = "\n".join([wrapped(a, 72), "", wrapped("1. " + b, 72), wrapped("2. " + c, 72)])
    first, last, name, *_ = li.Scanner().scan(text)[0]
    assert (first, last, name) == (0, text.count("\n"), "BSD-2-Clause")
    gpl = "This work is licensed under the GNU General Public License, version\n3. More prose."
    assert [f[2] for f in li.Scanner().scan(gpl)] == ["GPL-3.0"]


def test_several_notices_in_one_block():
    two = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0."]
    for sep in ("\n", " ", " and words between them "):
        found = li.Scanner().scan(sep.join(two))
        assert [f[2] for f in found] == ["MIT", "CC-BY-NC-4.0"]
    scanner = li.Scanner()
    every = [f[2] for f in scanner.scan("\n".join(w for _, w in li.TEMPLATES))]
    assert every == [n for n, _ in li.TEMPLATES]


LONG = {n: w for n, w in li.TEMPLATES if len(w) > 200}
PROSE = ["The copyright of nothing is told here.", "Some plain words.", "It comes without warranty",
         "To redistribute software in source and binary form is allowed.", "version 2 or 3 of it"]


def found(text, kind=li.Scanner):
    return [f[2] for f in kind().scan(text) if f[2] != "unknown"]


class InOrder(li.Scanner):
    """Templates in their order instead of by size reduction."""

    def reductions(self, words):
        return [(1.0, i) for i in range(len(self.templates))]


class Exhaustive(li.Scanner):
    """Without compression: of all templates that are confirmed, the one with
    the most words in the block wins."""

    def reductions(self, words):
        def fits(i):
            place = self.aligned(i, words, len(words))
            return place[1] - place[0] if place else 0
        return sorted(((1.0 + fits(i), i) for i in range(len(self.templates))),
                      key=lambda g: (-g[0], g[1]))


def test_compression_decides_between_wordings():
    bsd3, apache = LONG["BSD-3-Clause"], LONG["Apache-2.0"]
    assert found(bsd3) == ["BSD-3-Clause"] and found(bsd3, InOrder) == ["BSD-2-Clause"]
    assert len(li.Scanner().scan(apache)) == 1
    assert found(LONG["BSD-2-Clause"]) == ["BSD-2-Clause"]


def test_every_template_against_the_exhaustive_scan():
    import random
    rnd = random.Random(3)
    some = 0
    for _ in range(40):
        parts = []
        for name, wording in rnd.sample(li.TEMPLATES, 4):
            words = wording.split(" ")
            for _ in range(rnd.choice([0, 0, len(words) // 20, len(words) // 5])):
                words[rnd.randrange(len(words))] = rnd.choice(["other", "", "wholly new"])
            parts += [" ".join(words), *rnd.sample(PROSE, rnd.randint(0, 2))]
        text = rnd.choice(["\n", "\n\n\n\n\n", ". "]).join(parts)
        assert found(text) == found(text, Exhaustive), text
        some += len(found(text))
    assert some > 60


@pytest.mark.parametrize("text,names", [
    ("/* SPDX-License-Identifier: GPL-2.0-only */", ["GPL-2.0-only"]),
    ("# SPDX-License-Identifier: MIT", ["MIT"]), ("SPDX-License-Identifier: MIT-0", []),
    ("SPDX-License-Identifier: (MIT OR Apache-2.0)", ["MIT"]),
    ("SPDX-License-Identifier: BSD-3-Clause-Clear", []),
    ("SPDX-License-Identifier: GPL-2.0-or-later.", ["GPL-2.0-or-later"]),
    ("Licensed under the MIT license.", ["MIT"]),
    (LONG["GPL-2.0-or-later"].replace("; either version 2 ", ", either version 3 "),
     ["GPL-3.0-or-later"]),
    (LONG["LGPL-2.1-or-later"], ["LGPL-2.1-or-later"]),
    (LONG["LGPL-2.1-or-later"].replace("2.1", "2.2"), [])])
def test_versions_and_identifiers(text, names):
    assert found(text) == names
