import functools
import hashlib
import itertools
import math
import random
import re

import pytest

from ludex.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def plain(text):
    """The base spans by the patterns as they are given."""
    found = [(m.start(), m.end(), "email") for m in EMAIL.finditer(text)]
    for m in IP.finditer(text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        d = [int(c) for c in m[0] if c.isdigit()]
        odd, even = d[-1::-2], d[-2::-2]
        if 12 <= len(d) <= 19 and (sum(odd) + sum(sum(divmod(2 * x, 10)) for x in even)) % 10 == 0:
            found.append((m.start(), m.end(), "card"))
    for m in PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], ["email", "ip", "card", "phone"].index(s[2])))


TEXTS = ["", "no data", "a@b.c", "x@y", "a.b+c@d-e.f.g. and é@x.y @z.q a@@b.cc a@b@c.dd e@f..g",
         "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.002.0003.4 1.2.3.", "4111 1111 1111 1111, 4111111111111112",
         "4111-1111-1111-1111-4", "+1 (555) 010-9999. +12 + 34 +1234567890123456", "😀 a@b.co 😀 1.1.1.1",
         "1" * 300, "1." * 200, "a@b.c" * 20, "+1" * 30, "5500 0000 0000 0004+1 202 555 0100 x"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


def test_base_spans_of_random_texts():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=400, deadline=None)
    @given(st.text(alphabet="a0129.@+-_ ()é\n", max_size=60))
    def check(text):
        assert pii.base_spans(text) == plain(text)

    check()


def classed(word):
    return "<number>" if any(c.isdigit() for c in word) else \
        "<name>" if word[0].isupper() else "<word>"


def words(text):
    """(start, end, word) of the runs of letters and digits."""
    found, at = [], 0
    for is_word, run in itertools.groupby(text, str.isalnum):
        run = "".join(run)
        if is_word:
            found.append((at, at + len(run), run))
        at += len(run)
    return found


def entities(text):
    """The protected values of a text: lower case, digits of cards and phones."""
    found = set()
    for a, b, kind in plain(text):
        value = text[a:b].lower()
        found.add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value))
    return found


def brute(rows, threshold=0.85, support=3):
    """The spans and terms of every document by the definition: all pairs of
    an entity and a term of one document, counted over all documents."""
    texts = [t or "" for _, t in rows]
    spans = [plain(t) for t in texts]
    names = [entities(t) for t in texts]
    terms = [{w.lower() for *_, w in words(t)} | {classed(w) for *_, w in words(t)} for t in texts]

    def tells(e, t):
        p = sum(e in have for have in names) / len(rows)
        if p == 1:
            return False
        both = sum(e in have and t in told for have, told in zip(names, terms, strict=True))
        alone, k = sum(t in told for told in terms), math.log(support)
        return 1 + math.log2((both + k * p) / (alone + k)) / -math.log2(p) >= threshold

    tells, out = functools.cache(tells), []
    for text, found, here in zip(texts, spans, names, strict=True):
        marked = []
        for a, b, w in words(text) if here else ():
            by = [e for e in here if tells(e, w.lower())]
            if by and not any(a < end and start < b for start, end, _ in found):
                gone = any(tells(e, classed(w)) for e in by)
                marked.append((a, b, "" if gone else classed(w)))
        out.append(marked)
    return spans, out


def rows():
    out = [(i, f"word{i % 7} the of and {i} filler text here") for i in range(40)]
    out += [(100 + i, f"Call Zorbian Quux at zq@corp.example now number {i}") for i in range(5)]
    out += [(200, "zorbian alone"), (201, None), (202, "")]
    out += [(300, "ip 10.0.0.1 gateway Kestrel9"), (300, "ip 10.0.0.1 gateway Kestrel9"),
            (None, "the 10.0.0.1 gateway kestrel9 of"), (301, "see 10.0.0.1 gateway")]
    return out


def test_terms(make_docs):
    data = rows()
    spans, terms = brute(data)
    want = sorted(
        (str(i), hashlib.sha256(pii.span_text(s).encode()).hexdigest(), t)
        for (i, _), s, t in zip(data, spans, terms, strict=True))
    got = sorted((str(r["doc_id"]), r["base_sha256"],
                  [(t["start"], t["end"], t["to"]) for t in r["terms"]])
                 for r in pii.find(make_docs(data)).collect())
    assert got == want and any(t for _, _, t in want)


def test_sanitise(make_docs):
    out = {r["doc_id"]: r for r in pii.sanitise(make_docs(rows())).collect()}
    assert len(out) == len({i for i, _ in rows()})
    assert "<email>" in out[100]["text"] and "Zorbian" not in out[100]["text"]
    assert out[200]["text"] == "zorbian alone" and out[201]["text"] is None
    assert out[100]["_lx_rk"] == "k"


def test_edges(edge_docs, edge_rows, no_docs, spark, tmp_path):
    assert pii.find(edge_docs).count() == len(edge_rows)
    assert pii.find(no_docs).count() == 0
    edge_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = pii.op9_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(edge_rows) and {r["spans"] for r in got} == {""}


def test_terms_far_from_a_mention(make_docs):
    far = "Zorbian " + "pad " * 60 + "{} zq@corp.example " + "pad " * 60 + "zorbian"
    data = [(i, far.format(f"Quux{i}")) for i in range(4)] + [(9, "pad zq@corp.example")]
    data += [(100 + i, f"pad of filler {i}") for i in range(200)]
    out = {r["doc_id"]: r for r in pii.sanitise(make_docs(data)).collect()}
    assert all("orbian" not in out[i]["text"] for i in range(4))
    spans, terms = brute(data)
    got = {r["doc_id"]: [(t["start"], t["end"], t["to"]) for t in r["terms"]]
           for r in pii.find(make_docs(data)).collect()}
    assert got == {i: t for (i, _), t in zip(data, terms, strict=True)}


def test_rare_entities_have_terms(make_docs):
    data = [(1, "Write to Zorbian at zq@corp.example")]
    data += [(100 + i, f"write to at filler {i}") for i in range(600)]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(data)).collect()}
    assert "orbian" not in out[1] and out[1].lower().startswith("write to ")
    # One document is little in a small corpus.
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(make_docs(data[:20])).collect()}
    assert "Zorbian" in out[1]


def test_random_corpora_against_the_definition(make_docs):
    rnd = random.Random(5)
    some = 0
    for n, threshold, support in ((30, 0.85, 3), (300, 0.85, 3), (120, 0.5, 1), (120, 1.0, 1)):
        data = []
        for i in range(n):
            text = [rnd.choice(["alpha", "beta", "Gamma9", "7", "the", "The", f"Rare{rnd.randint(0, n)}"])
                    for _ in range(rnd.randint(0, 12))]
            for _ in range(rnd.choice([0, 0, 0, 1, 3])):
                text.insert(0, f"u{rnd.randint(0, n // 8)}@corp.example")
            data += [(i, " ".join(text))] * rnd.choice([1, 1, 1, 2])
        spans, terms = brute(data, threshold, support)
        want = sorted((i, repr(s), repr(t)) for (i, _), s, t in zip(data, spans, terms, strict=True))
        got = sorted((r["doc_id"], repr([(s["start"], s["end"], s["kind"]) for s in r["base"]]),
                      repr([(t["start"], t["end"], t["to"]) for t in r["terms"]]))
                     for r in pii.find(make_docs(data), threshold, support).collect())
        assert got == want
        some += sum(map(len, terms))
    assert some


def test_a_list_of_addresses_is_one_group(make_docs):
    """Entities of the same documents meet the words of their documents once."""
    addresses = " ".join(f"u{i}@corp.example" for i in range(2000))
    data = [(1, addresses + " " + " ".join(f"Only{i}" for i in range(2000)))]
    data += [(10 + i, "plain words of prose") for i in range(600)]
    out = {r["doc_id"]: r["terms"] for r in pii.find(make_docs(data)).collect()}
    assert len(out[1]) == 2000 and not any(out[i] for i in out if i != 1)
