import numpy as np

from ludex.llm import setsketch as ss


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(a):
        while group[a] != a:
            a = group[a]
        return a
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                group[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = doc_id if not sets[i] else min(ids, default=None)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_edge_cases(edge_docs, edge_rows):
    got = [tuple(r) for r in ss.near_duplicates(edge_docs).collect()]
    assert sorted(got, key=key) == sorted(brute(edge_rows), key=key)


def test_empty(no_docs):
    assert ss.near_duplicates(no_docs).count() == 0
    assert ss.keep_one_per_group(no_docs).columns == no_docs.columns


def test_star_and_chain_of_variants(make_docs):
    # Variants of one base that are not similar to each other, and a chain in
    # which only neighbours are similar.
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for k in range(40):
        words = list(base)
        for at in rng.choice(300, 4, replace=False):
            words[at] = f"v{k}x{at}"
        rows.append((k, " ".join(words)))
    chain = [f"c{i}" for i in range(200)]
    for k in range(30):
        rows.append((2000 + k, " ".join(chain)))
        chain[(k * 7) % 200] = f"z{k}"
        chain[(k * 7 + 90) % 200] = f"y{k}"
    got = sorted(tuple(r) for r in ss.near_duplicates(make_docs(rows)).collect())
    assert got == sorted(brute(rows))


def test_keep_one(edge_docs):
    kept = ss.keep_one_per_group(edge_docs)
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda x: (x is None, x))
    # Without words: all stay; 5 leads its copies, 9 its near copies.
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9, 12, None]


def test_estimate_and_merge():
    rng = np.random.default_rng(2)
    for share in (0.2, 0.6, 0.9):
        both = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        own = int(4000 * share)
        rest = rng.integers(0, 1 << 63, 2 * (4000 - own), dtype=np.uint64)
        a = np.concatenate([both[:own], rest[: 4000 - own]])
        b = np.concatenate([both[:own], rest[4000 - own:]])
        ra, rb = (ss.registers(x, np.array([0]))[0] for x in (a, b))
        true = own / (8000 - own)
        guess = ss.estimate(*(np.array([x]) for x in ((ra > rb).sum(), (ra < rb).sum(),
                                                      4000.0, 4000.0)))[0]
        assert abs(guess - true) < 0.1
        union = ss.registers(np.concatenate([a, b]), np.array([0]))[0]
        assert (ss.merge_sketches(ra, rb) == union).all()
