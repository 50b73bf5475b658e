from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from stratalog.llm import chat_trees as C

NODES = "tree long, node long, parent long, role string, text string, score double, key string"


def brute(rows, per_tree):
    """Walk up from every leaf."""
    by = {(t, n): (p, s) for t, n, p, _, _, s, _ in rows}
    parents = {(t, p) for (t, _), (p, _) in by.items()}
    paths = {}
    for t, n in by:
        if (t, n) in parents:
            continue
        path, at = [], n
        while at is not None and (t, at) in by and at not in path:
            path.append(at)
            at = by[t, at][0]
        if at is not None and (t, at) in by:
            continue
        paths.setdefault(t, []).append(path[::-1])
    out = set()
    for t, all_ in paths.items():
        score = {tuple(p): sum(by[t, n][1] or 0.0 for n in p) / len(p) for p in all_}
        best = sorted(all_, key=lambda p: (-score[tuple(p)], -len(p), p[-1]))[:per_tree]
        out |= {(t, p[-1], rank, n, at) for rank, p in enumerate(best, 1) for at, n in enumerate(p)}
    return out


def tree_rows():
    rows = []
    for t in (1, 2, None):
        for n in range(1, 60):
            parent = None if n == 1 else (n * 7 + (t or 0)) % n or 1
            rows.append((t, n, parent, "user" if n % 2 else "assistant", f"m{n}", (n * 13 % 8) / 4, "k"))
    rows += [(3, n, n - 1 if n > 1 else None, "user", "x", None, "k") for n in range(1, 40)]  # a chain
    rows += [(4, 1, 2, "user", "x", 1.0, "k"), (4, 2, 1, "user", "x", 1.0, "k"), (4, 3, 2, "user", "x", 1.0, "k")]  # a cycle
    rows += [(5, 8, 99, "user", "lost", 1.0, "k"), (6, 1, None, None, None, None, None)]
    return rows


def test_paths_equal_walks(spark):
    rows = tree_rows()
    for k in (1, 3):
        got = C.chosen_paths(spark.createDataFrame(rows, NODES), k)
        assert {tuple(r) for r in got.select("tree", "leaf", "rank", "node", "at").collect()} == brute(rows, k)


def test_escapes_round_trip(spark):
    texts = ["", "\\", "\\0", "\\1<", "<|turn|>", "<|end|>\n", "[INST]\\2", "\\\\<[<|", "</s>[INST] ok [/INST]", "a\nb", "é\U0001f600<"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    coded = C.escaped(F.col("t"))
    for r in df.select("t", coded.alias("c"), C.unescaped(coded).alias("back")).collect():
        assert r["back"] == r["t"] and "<" not in r["c"] and "[" not in r["c"]


def test_formatted_reads_back(spark):
    rows = [
        (1, 1, None, "sys<tem\n", "be <|end|> kind", 0.0, "k"), (1, 2, 1, "user", None, 0.0, "k"),
        (1, 3, 2, "assistant", "yes\\1 <|turn|>", 0.0, "k"), (1, 4, 3, None, "w" * 200_000, 0.0, "k"),
        (1, 5, 4, "assistant", "", 0.0, "k"),
    ]
    out = C.formatted(spark.createDataFrame(rows, NODES)).withColumn("turns", C.read_turns(F.col("formatted"))).first()
    assert out["formatted"] == "".join(s["text"] for s in out["segments"])
    assert tuple(out["turns"][0]) == ("sys<tem\n", "be <|end|> kind")
    assert [t["text"] for t in out["turns"]][1:] == ["", "yes\\1 <|turn|>", "w" * 200_000, ""]
    assert [s["text"].replace("\\1", "<") for s in out["segments"] if s["loss"]] == ["yes\\01 <|turn|>", ""]
    assert C.formatted(spark.createDataFrame([], NODES)).count() == 0


def test_chain_orders_ties(spark):
    rows = [(1, 2, "user", "b"), (1, 2, "user", "a"), (1, None, None, None), (1, 0, "user", "c"), (None, 5, "user", "d"), (1, 2, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes = C.chain(df)
    got = [r["text"] for r in nodes.where("tree = 1").orderBy("node").collect()]
    assert got == ["c", "a", "a", "b", None]
    assert C.formatted(nodes).count() == 2
    digest = C.formatted(nodes).where("tree is null").select(F.sha2("formatted", 256)).first()[0]
    assert digest == hashlib.sha256(b"<|turn|>user\nd<|end|>\n").hexdigest()
