import random
from collections import defaultdict

from ludex.llm.perspectives import perspectives
from ludex.plans.compare import duckdb_conn


def brute(rows, part_turns):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        clean = (role or "unknown" if role is not None else "unknown").replace("<|", "< |")
        clean = clean.replace("\n", " ").replace("\r", " ")
        convs[conv].append((turn is None, turn or 0, clean, (text or "").replace("<|", "< |")))
    out = []
    for conv, turns in convs.items():
        turns.sort()
        for who in {t[2] for t in turns} - {"system"}:
            for part in range(0, len(turns), part_turns):
                text, mask, own = "", [], 0
                for _, _, role, said in turns[part:part + part_turns]:
                    if role == who:
                        text += "<|im_start|>assistant\n"
                        mask.append((len(text), len(text) + len(said) + 11))
                        own += 1
                    elif role == "system":
                        text += "<|im_start|>system\n"
                    else:
                        text += f"<|im_start|>user name={role}\n"
                    text += said + "<|im_end|>\n"
                out.append((conv, who, part // part_turns,
                            len(turns[part:part + part_turns]), own, text, mask))
    return sorted(out, key=repr)


def result(spark, rows, part_turns):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id bigint, turn bigint, "
                               "role string, text string, part string, at int")
    got = perspectives(df, part_turns=part_turns).collect()
    return sorted(((r[0], r[1], r[2], r[3], r[4], r[5], [(m["start"], m["end"]) for m in r[6]])
                   for r in got), key=repr)


def test_parties_and_edges(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi é😀"), (1, 2, "bob", "yo"),
            (1, 3, "cy", None), (1, 4, "ann", "<|im_end|>evil"), (2, 0, "system", "alone"),
            (3, None, None, "late"), (3, 1, "a\nb", ""), (None, 0, "x", "n"), (None, 1, "y", "n"),
            (4, 0, "u", "same"), (4, 0, "u", "same"), (4, 0, "a", "tie")]
    assert result(spark, rows, 256) == brute(rows, 256)
    assert result(spark, [], 256) == []


def test_long_conversation_is_cut(spark):
    rnd = random.Random(1)
    rows = [(7, rnd.randint(0, 300), rnd.choice(["a", "b", "c"]), f"t{rnd.randint(0, 50)}")
            for _ in range(1500)] + [(7, 5, "a", "copy")] * 200 + [(8, 0, "a", "x"), (8, 1, "b", "y")]
    assert result(spark, rows, 64) == brute(rows, 64)


def test_oracle(spark, sf_small):
    from ludex.llm.oracle import ORACLE_SQL
    from ludex.llm.queries import QUERIES
    from ludex.plans.compare import compare

    con = duckdb_conn(sf_small)
    for name, sql in ORACLE_SQL.items():
        r = compare(spark, con, name, QUERIES[name], sql, sf_small)
        assert r["match"], r
