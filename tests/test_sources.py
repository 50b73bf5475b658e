from __future__ import annotations

import json
from urllib.parse import unquote

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from stratalog.bindings import files
from stratalog.config import MixConfig, SkewConfig, TokenConfig
from stratalog.functions import messages as M
from stratalog.plans import corpus as plan
from stratalog.sources import array_files, chat_files, log_files


def line(*messages, **extra):
    return json.dumps({"messages": [{"role": r, "content": c} for r, c in messages], **extra}, ensure_ascii=False)


GOOD = line(("user", "q é x"), ("assistant", "a"), meta={"type": "geo", "category": None})
LINES = [
    GOOD, "", "   ", "{bad", '{"messages": 5}', "{}", "[1]", line(("user", "q"), ("assistant", 5)),
    line(("user", "q"), (7, "x"), ("assistant", "a")), '{"messages": [3]}', line(("user", "q")),
    '{"messages": [], "messages": []}', "  " + line(("user", "q"), ("assistant", "b")) + "  ",
]


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(LINES), encoding="utf-8")
    good, bad = chat_files.read_jsonl(spark, str(tmp_path))
    rows = good.orderBy("block", "row").collect()
    assert [r["messages"][1]["content"] for r in rows] == ["a", "b"]
    assert rows[0]["messages"][0]["content"] == "q é x"
    assert rows[0]["meta"]["type"] == "geo" and rows[0]["source"] == "a.jsonl"
    errors = [r["error"] for r in bad.orderBy("block", "row").collect()]
    assert errors == [
        "invalid JSON", "messages missing or not a list", "messages missing or not a list",
        "messages missing or not a list", "blank content in role assistant", "unknown role: none",
        "no user or assistant message", "no user or assistant message", "invalid JSON",
    ]
    assert [r["line_no"] for r in bad.orderBy("line_no").collect()] == [4, 5, 6, 7, 8, 9, 10, 11, 12]
    counts = chat_files.integrity(spark, str(tmp_path)).first()
    assert (counts["n_valid"], counts["n_malformed"]) == (9, 2)
    with pytest.raises(ValueError):
        chat_files.count_valid(spark, str(tmp_path))


def test_flexible(spark, tmp_path):
    (tmp_path / "array.json").write_text(f"\n  [{GOOD},\n{line(('user', 'x'), ('assistant', 'y'))}, 4]")
    (tmp_path / "lines.jsonl").write_text(f"{GOOD}\n{{bad\n")
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "broken.json").write_text("[{")
    good, bad = array_files.read_flexible(spark, str(tmp_path))
    got = sorted((r["source"], r["messages"][1]["content"]) for r in good.collect())
    assert got == [("array.json", "a"), ("array.json", "y"), ("lines.jsonl", "a")]
    assert sorted((r["source"], r["error"]) for r in bad.collect()) == [
        ("array.json", "messages missing or not a list"), ("broken.json", "array without end"), ("broken.json", "invalid JSON"),
        ("lines.jsonl", "invalid JSON"),
    ]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [("user", "é"), ("assistant", "a")])], f"n_tokens long, messages {M.MESSAGES}")
    chat_files.write_jsonl(df, str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text) == {"messages": [{"role": "user", "content": "é"}, {"role": "assistant", "content": "a"}]}
    assert "é" in text
    chat_files.write_dropped(df.select("n_tokens", F.struct("messages").alias("example")), str(tmp_path / "drop"))
    assert spark.read.json(str(tmp_path / "drop")).first()["n_tokens"] == 1
    assert chat_files.count_valid(spark, str(tmp_path / "out")) == 1


def test_csv(spark, tmp_path):
    (tmp_path / "w.csv").write_text("Dept,gr,Well,nphi\n1,-999.25,A,NA\n2,5.5,,-999\n3,NaN,A,0.2\n")
    df = log_files.read_csv(spark, str(tmp_path)).orderBy("block", "row")
    assert df.columns[:4] == ["DEPT", "GR", "WELL", "NPHI"]
    assert [tuple(r)[:4] for r in df.collect()] == [
        (1.0, None, "A", None), (2.0, 5.5, None, None), (3.0, None, "A", 0.2),
    ]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.csv").write_text("GR,gr\n1,2\n")
    # names that differ only by case are told apart, so neither passes for the curve
    assert "GR" not in log_files.read_csv(spark, str(tmp_path / "sub")).columns


LAS = """~Version
 VERS. 2.0 : CWLS
 WRAP. NO : one line
~Well
 STRT.M 1 : start
 NULL. -1.5 : null
 WELL. 25/5-1 : name of well
~Curve information
# comment
 DEPT.M : depth
 GR .API 07 : gamma: raw
 nphi.V/V : neutron
~Params
 X. 1 : y
~A DEPT GR NPHI
 1.0  50.5  0.2
 2.0  -999.25 -1.5

 3.0  7
# note
 4.0  -999.9  1e-1
"""


def test_las(spark, tmp_path, values):
    (tmp_path / "a.LAS").write_bytes(LAS.replace("\n", "\r\n").encode())
    (tmp_path / "b.las").write_text(LAS.replace("WRAP. NO", "WRAP. YES").replace("25/5-1", "wrapped"))
    (tmp_path / "c.las").write_text("no sections")
    (tmp_path / "d.las").write_text(LAS.replace(" WELL. 25/5-1 : name of well\n", ""))
    (tmp_path / "big.las").write_text(LAS.replace("25/5-1", "big") + "\n" * 2000)
    (tmp_path / "x.txt").write_text("x")
    long, rejects = log_files.read_las(spark, str(tmp_path))
    got = values(long.where("well = '25/5-1'"), "depth", "curve", "value")
    assert got == [
        (1.0, "GR", 50.5), (1.0, "NPHI", 0.2), (2.0, "GR", None), (2.0, "NPHI", None),
        (4.0, "GR", None), (4.0, "NPHI", 0.1),
    ]
    assert {r["well"] for r in long.select("well").distinct().collect()} == {"25/5-1", "big", "d", "wrapped"}
    # values go on over the lines; two are left for the last record
    assert values(long.where("well = 'wrapped'"), "depth", "curve", "value", "row") == [
        (1.0, "GR", 50.5, 16), (1.0, "NPHI", 0.2, 16), (2.0, "GR", None, 17), (2.0, "NPHI", None, 17),
        (3.0, "GR", 7.0, 19), (3.0, "NPHI", 4.0, 19),
    ]
    errors = sorted((r["path"].rsplit("/", 1)[1], r["error"]) for r in rejects.collect())
    assert errors == [
        ("a.LAS", "wrong number of values in line 19"), ("b.las", "wrong number of values in line 21"),
        ("big.las", "wrong number of values in line 19"), ("c.las", "no curve or data section"),
        ("d.las", "wrong number of values in line 18"),
    ]
    wide = log_files.las_wide(long, ["GR", "NPHI"]).where("well = 'd'").orderBy("DEPT").collect()
    assert [(r["DEPT"], r["GR"], r["NPHI"]) for r in wide] == [(1.0, 50.5, 0.2), (2.0, None, None), (4.0, None, 0.1)]
    listed = {r["file"]: r["error"] for r in log_files.listing(spark, str(tmp_path), 2000).collect()}
    assert listed["a.LAS"] is None and listed["big.las"].startswith("file exceeds")
    assert listed["x.txt"].startswith("unsupported file type: 'x.txt'. Upload a .las")


def test_files_in_many_splits(spark, tmp_path):
    """Line numbers and sections hold when a file is read in small pieces; long curve lists stay whole."""
    many = [f"C{i}" for i in range(300)]
    head = ["~V", "~C", "DEPT.M :", *(f"{c}. :" for c in many), "~A"]
    rows = [" ".join(map(str, [d, *[0.5] * 300])) for d in range(500)] + ["7 8"]
    (tmp_path / "wide.las").write_text("\n".join(head + rows))
    (tmp_path / "x.jsonl").write_text("\n".join([GOOD] * 2_000 + ["{bad"] + [GOOD] * 500))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        long, rejects = log_files.read_las(spark, str(tmp_path))
        assert long.count() == 500 * 300
        assert [r["error"] for r in rejects.collect()] == [f"wrong number of values in line {len(head) + 501}"]
        _, bad = chat_files.read_jsonl(spark, str(tmp_path / "x.jsonl"))
        assert [r["line_no"] for r in bad.collect()] == [2_001]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("size,fine", [(50 * 1024 * 1024, True), (50 * 1024 * 1024 + 1, False)])
def test_size_cap_is_strict(spark, size, fine):
    df = spark.createDataFrame([("W.LAS", size)], "name string, length long")
    error = df.select(log_files.upload_errors(F.col("name"), F.col("length"))).first()[0]
    assert (error is None) == fine


def test_build_and_write(spark, tmp_path):
    instructions = spark.createDataFrame(
        [(i, "geo", "a.b", f"ask {i % 30}", "", f"a long enough answer {i % 30}") for i in range(60)],
        "row_id long, type string, category string, instruction string, input string, output string",
    )
    (tmp_path / "in.jsonl").write_text("\n".join(
        [line(("user", f"ask {i}"), ("assistant", f"a long enough answer {i}")) for i in range(25, 45)]
        + [line(("user", "x"), ("assistant", "short")), line(("user", "long"), ("assistant", "y" * 9000))]
    ))
    chats, bad = chat_files.read_jsonl(spark, str(tmp_path / "in.jsonl"))
    assert bad.count() == 0
    # the system message does not count: examples 25 to 29 are in both inputs
    pool = plan.instruction_examples(instructions, "rows").unionByName(
        chats.select(F.lit(1).alias("rank"), "block", "row", "source", "messages")
    )
    factors = spark.createDataFrame([("in.jsonl", 3), ("gone", 2)], "source string, factor int")
    built = plan.build(pool, factors, MixConfig(merge_val_fraction=0.1), TokenConfig())
    assert {r["source"]: r["n"] for r in built.composition.collect()} == {"rows": 30, "in.jsonl": 16}
    assert built.val.count() + built.train.where("copy = 1").count() + built.dropped.count() == 46
    # the split is made on all 46 rows, before the token filter
    n_dropped = built.dropped.where("split = 'val'").count()
    assert built.val.count() + n_dropped == 4 and built.dropped.count() == 1
    assert [r["source"] for r in built.unknown_sources.collect()] == ["gone"]
    copies = built.train.groupBy("source", "key").count().groupBy("source").agg(F.max("count").alias("m"))
    assert {r["source"]: r["m"] for r in copies.collect()} == {"rows": 1, "in.jsonl": 3}
    assert built.train.join(built.val, "key", "left_semi").count() == 0
    plan.write(built, str(tmp_path / "out"))
    assert chat_files.count_valid(spark, str(tmp_path / "out" / "train")) == built.train.count()


def test_append_plan(spark, tmp_path):
    def chats(*pairs):
        rows = [([{"role": r, "content": c} for r, c in p],) for p in pairs]
        return spark.createDataFrame(rows, f"messages {M.MESSAGES}")

    def pair(q, *before):
        return [*before, ("user", q), ("assistant", f"answer {q}")]

    train, val = chats(pair("t"), pair("old")), chats(pair("v"), [("user", "no answer")])
    new = chats(pair("t"), pair("v"), pair("n", ("system", "x")), pair("n"), [("user", "q")])
    report, rejects = plan.append(new, train, val, str(tmp_path / "out"), factor=3)
    assert tuple(report.first()) == (1, 1, 2) and rejects.count() == 1
    good, _ = chat_files.read_jsonl(spark, str(tmp_path / "out"))
    got = {}
    for r in good.collect():
        got.setdefault(r["messages"][-2]["content"], []).append(r["messages"][0])
    # the two copies inside the new set survive, each three times and with the standard message
    assert {k: len(v) for k, v in got.items()} == {"t": 1, "old": 1, "n": 6}
    assert {m["role"] for m in got["n"]} == {"system"} and len({m["content"] for m in got["n"]}) == 1
    report, _ = plan.append(chats(pair("t")), train, val, str(tmp_path / "none"))
    assert report.first()["added"] == 0 and not (tmp_path / "none").exists()


def test_wrapped_records_over_split_borders(spark, tmp_path, values):
    """Splits of 64 bytes cut through records, lines and the header."""
    head = LAS[: LAS.index(" 1.0  50.5")].replace("WRAP. NO", "WRAP. YES")
    want, lines = [], []
    for i in range(60):
        row = [str(i), f"{i}.25", f"{i}.5"]
        lines += [" ".join(row)] if i % 3 == 0 else [row[0], " ".join(row[1:])] if i % 3 == 1 else row
        want += [(float(i), "GR", i + 0.25), (float(i), "NPHI", i + 0.5)]
    (tmp_path / "w.las").write_text(head + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        long, rejects = log_files.read_las(spark, str(tmp_path))
        assert values(long, "depth", "curve", "value") == sorted(want) and rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_array_items_over_split_borders(spark, tmp_path, max_rows):
    """Splits of 300 bytes cut through items, strings and escapes; commas and brackets in strings."""
    texts = ['a, "b" [c], {d}', "\\\\", 'x\\', "é, ], \"", "", "[[[", "}}", 'end"]'] * 3
    rows = [{"messages": [{"role": "user", "content": f"q{i}, {t}"}, {"role": "assistant", "content": f"a{i} {t}."}]} for i, t in enumerate(texts)]
    flat = json.dumps(rows, ensure_ascii=False, separators=(",", ":"))
    (tmp_path / "one.json").write_text(flat)  # one line
    (tmp_path / "many lines.json").write_text("\n " + json.dumps(rows, indent=1) + "\n\n")
    (tmp_path / "cut.json").write_text(flat[: flat.rindex(',{"messages"')])
    (tmp_path / "none.json").write_text(" [ \n] ")
    (tmp_path / "comma.json").write_text("[1,]")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        good, bad = array_files.read_flexible(spark, str(tmp_path), SkewConfig(max_rows=max_rows))
        got = {}
        for r in good.collect():
            got.setdefault(unquote(r["source"]), {})[r["row"]] = [m["content"] for m in r["messages"]]
        rejects = sorted((r["source"], r["line_no"], r["error"]) for r in bad.fillna(0, ["line_no"]).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {i: [m["content"] for m in r["messages"]] for i, r in enumerate(rows)}
    assert got["one.json"] == want and got["many lines.json"] == want
    assert got["cut.json"] == {i: m for i, m in want.items() if i < len(rows) - 1} and set(got) == {"one.json", "many lines.json", "cut.json"}
    assert rejects == [
        ("comma.json", 1, "messages missing or not a list"), ("comma.json", 2, "invalid JSON"), ("cut.json", 0, "array without end"),
    ]


def test_write_parts_makes_no_file_through_hadoop(spark, tmp_path):
    """A file per part, whole and in order; none by Spark's writer, which starts processes for each."""
    rows = [(f"w{i % 40}", f"{i:05d} é") for i in range(4_000)] + [("w3", None), ("w3", "")]
    df = spark.createDataFrame(rows, "part string, line string").repartition("part").sortWithinPartitions("part", "line")
    root = tmp_path / "out"
    log_files.write_parts(df, str(root), "las")
    assert not list(root.rglob(".*")) and not list(root.rglob("_*")) and not list(root.rglob("part*"))
    got = {}
    for file in root.rglob("*.las"):
        lines = file.read_text(encoding="utf-8").split("\n")
        assert lines.pop() == ""
        got[min(line for line in lines if len(line) > 2)] = lines
    want = {}
    for part, line in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
        want.setdefault(part, []).append("" if line is None else line or '""')
    assert sorted(got.values()) == sorted(want.values())
    assert log_files.listing(spark, str(root)).count() == 40


def test_write_parts_by_sparks_writer_elsewhere(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log_files, "_local_folder", lambda *_: None)
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], "part string, line string")
    log_files.write_parts(df.coalesce(1).sortWithinPartitions("part", "line"), str(tmp_path / "out"), "las")
    assert log_files.listing(spark, str(tmp_path / "out")).where("kind = 'las'").count() == 2


def test_read_las_opens_files_once_for_their_lines(spark, tmp_path):
    (tmp_path / "a.las").write_text("~V\n VERS. 2.0 : v\n~W\n WELL. A : name\n~C\n DEPT.M : d\n GR.API : g\n~A\n1 2\n3 4\n")
    long, _ = log_files.read_las(spark, str(tmp_path))
    plan = long._jdf.queryExecution().toString()
    assert "FileScan parquet" in plan and "FileScan text" not in plan
    assert sorted((r["well"], r["row"], r["depth"], r["value"]) for r in long.collect()) == [("A", 9, 1.0, 2.0), ("A", 10, 3.0, 4.0)]


HEAD = "~V\n WRAP. NO : w\n~W\n NULL. -1.5 :\n WELL. {} : name\n~C\n DEPT.M : d\n GR.API : g\n NPHI.V/V : n\n"


def odd_folder(root):
    """Names, line ends, bytes and sections as they come; some files that Spark's readers pass over."""
    head = HEAD.format
    wrap = HEAD.replace("WRAP. NO", "WRAP. YES").format
    data = "".join(f" {i}.0  {i}.5\t-1.5\n" if i % 7 else f"\n# no. {i}\n  {i} 2\n" for i in range(60))
    texts = {
        "a b%20é .las": HEAD.replace(" WELL. {} : name\n", "") + "~A\n" + data,
        "sub/_x=1/b.LAS": head("b").replace("\n", "\r\n") + "~a x\r\n" + data.replace("\n", "\r\n"),
        "sub/cr.lAs": (head("cr") + "~A\n" + data).replace("\n", "\r"),
        "sub/twice.las": head("twice") + "~A\n1 2 3\n~P\n x. 1 : y\n~A\n4 5 6\n",
        "wrapped.las": wrap("wr") + "~A\n1\n2 3\n\n4 5\n# x\n6 7\n8\n9 10\n",
        "wrapped-none.las": wrap("none") + "~A\n\n# x\n",
        "wrapped-long.las": wrap("long") + "~A\n" + "".join(f"{i}\n{i}.25  {i}.5\n" for i in range(80)),
        "first.las": "~A\n1 2 3\n", "empty.las": "", "no.las": "no sections\n~C\n DEPT.M : d", "none.las": "~C\n# x\n~A\n1\n",
        "long.las": head("long line") + "# " + "x" * 500 + "\n~A\n" + "1 2 " + " " * 400 + "3\n4 5 6",
        "_hidden/c.las": head("c") + "~A\n1 2 3\n", ".h/d.las": head("d") + "~A\n1 2 3\n", "_y.las": "", ".z.las": "", "x._COPYING_": "",
        "x.txt": "x", "sub/t=.csv": "", "sub/#?[1]{2}.las": head("marks") + "~A\n1 2 3\n",
    }
    for name, text in texts.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(text.encode())
    (root / "latin.las").write_bytes((head("25° é") + "~A\n1 2 3\n7 \xb0 9\n").encode("latin-1"))
    (root / "mark.las").write_bytes(b"\xef\xbb\xbf" + (head("mark") + "~A\n1 2 3\n").encode())
    (root / "gone.las").symlink_to(root / "nowhere")
    (root / "link.las").symlink_to(root / "first.las")
    (root / "linked").symlink_to(root / "sub")


def without_sparks_listing(monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("the driver would hold the names of all files")

    for name in ("load", "text"):
        monkeypatch.setattr(DataFrameReader, name, refuse)


def test_mounted_folders_are_listed_by_tasks(spark, tmp_path, values, monkeypatch):
    odd_folder(tmp_path)
    columns = ("path", "file", "length", "kind", "error")
    paths = [str(tmp_path), f"{tmp_path}//sub/", [str(tmp_path / "sub"), str(tmp_path)]]
    with monkeypatch.context() as m:
        m.setattr(log_files, "_local_folder", lambda *_: None)
        want = [values(log_files.listing(spark, p, 300), *columns) for p in paths]
    without_sparks_listing(monkeypatch)
    for p, w in zip(paths, want, strict=True):
        assert values(log_files.listing(spark, p, 300), *columns) == w
    assert len(want[0]) == 20


def test_las_files_of_mounted_folders_are_read_by_tasks(spark, tmp_path, values, monkeypatch):
    """Rows, line numbers and rejects are those of Spark's text reader, for files in one row and in pieces."""
    odd_folder(tmp_path)

    def read():
        long, rejects = log_files.read_las(spark, str(tmp_path))
        return values(long, "path", "well", "row", "depth", "curve", "value"), values(rejects, "path", "error")

    with monkeypatch.context() as m:
        m.setattr(log_files, "_local_folder", lambda *_: None)
        want = read()
    without_sparks_listing(monkeypatch)
    for size in (log_files.PIECE_BYTES, 300, 47):
        monkeypatch.setattr(log_files, "PIECE_BYTES", size)
        assert read() == want
    wells = {r[1] for r in want[0]}
    assert {"b", "cr", "twice", "wr", "long", "mark", "a%20b%2520é%E2%80%A8"} <= wells and not wells & {"c", "d", "none"}


def test_queries_list_no_file_on_the_driver(spark, tmp_path, values, monkeypatch):
    """Thirty suppliers: as many LAS files, none of which Spark's listing holds."""
    spark.range(300).select(
        (F.col("id") % 90).alias("l_orderkey"), (F.col("id") % 30).alias("l_suppkey"), (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.col("id").cast("double").alias("l_quantity"), (F.col("id") / 1000).alias("l_discount"),
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(1).write.parquet(str(tmp_path / "nation.parquet"))
    without_sparks_listing(monkeypatch)
    assert values(files.upload_listing(spark, str(tmp_path)), "kind", "error", "n") == [("las", None, 30), ("parquet", "unsupported type", 1)]
    assert [(r["too_large"], r["n"]) for r in files.upload_size_cap(spark, str(tmp_path)).collect()] == [(False, 30)]
    rows = values(files.ingest_las(spark, str(tmp_path)), "well", "depth", "curve", "value")
    assert len(rows) == 600 and rows == values(files.ingest_las_wrapped(spark, str(tmp_path)), "well", "depth", "curve", "value")
