"""Row repair on text files, read whole and in tiny splits, against a plain pass over each file's lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lakeops.operators import repair
from lakeops.operators.repair import LOG
from lakeops.sources.files import read_lines, read_multiline_csv

HEAD = "Customer Id,Phone number,Customer Name,Login Time"
STAMP = re.compile(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}")
SAMPLE = [
    HEAD,
    "100001,0900000001,Ann Lee,2019-03-04 05:06:07",
    "100002,0900000002,Bob,Ray,2022-11-10 16:01:00",
    "100003,0900000003,Cy",
    "Dee,2022-11-10 16:02:00",
    "100004,0900000004,Eve",
    "",
    "Fay Gil,2022-11-10 16:03:00",
    "",
    "Customer Id",
    "100005,0900000005,Hal",
]


@pytest.fixture
def read(spark, tmp_path):
    """Write files and read them back in splits of a given size."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {k: spark.conf.get(k) for k in keys}

    def go(files, split_bytes=None):
        folder = tmp_path / f"in{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        for name, lines in files.items():
            (folder / name).write_text("".join(line + "\n" for line in lines))
        if split_bytes:
            spark.conf.set(keys[0], str(split_bytes))
            spark.conf.set(keys[1], "0")
        return read_lines(spark, str(folder))

    yield go
    for k, v in old.items():
        spark.conf.set(k, v)


def cells(line):
    parts = line.strip(" ").split(",") if line.strip(" ") else []
    return (parts + [None] * 5)[:5]


def kept(lines):
    out = []
    for line in lines:
        c = cells(line)
        heading = c[0] is not None and all(v is None or v == h for v, h in zip(c, HEAD.split(",")))
        if heading or all(v is None for v in c):
            continue
        out.append(c)
    return out


def delimiter(row):
    i, p, n, s, spill = row
    if s is not None and not re.fullmatch(STAMP, s):
        n = None if n is None else n + " " + s
    return [i, p, n, spill if spill else s]


def linebreak(rows, name_min, stamp_min):
    out = []
    for k, (i, p, n, s) in enumerate(rows):
        if s is None and k + 1 < len(rows) and rows[k + 1][2] is None and rows[k + 1][3] is None:
            rest, stamp = rows[k + 1][:2]

            def long(least):
                return least is None or (stamp is not None and len(stamp) > least)

            n, s = (n + " " + rest if n is not None and long(name_min) else n if long(name_min) is False else None), (
                stamp if long(stamp_min) else s
            )
        if n is not None or s is not None:
            out.append((i, p, n, s))
    return out


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


def test_sample(read):
    got = repair.clean_log(read({"a.csv": SAMPLE})).select(*LOG.cells)
    assert bag(got.collect()) == bag(
        [
            ("100001", "0900000001", "Ann Lee", "2019-03-04 05:06:07"),
            ("100002", "0900000002", "Bob Ray", "2022-11-10 16:01:00"),
            ("100003", "0900000003", "Cy Dee", "2022-11-10 16:02:00"),
            ("100004", "0900000004", "Eve Fay Gil", "2022-11-10 16:03:00"),
            ("100005", "0900000005", "Hal", None),
        ]
    )


def test_equal_cells_stay(read):
    got = repair.split_cells(read({"a.csv": ["7,09,,", "7,7", "1,2,3,4,5,6"]})).select(*LOG.cells, LOG.spill)
    assert bag(got.collect()) == bag(
        [("7", "09", "", "", None), ("7", "7", None, None, None), ("1", "2", "3", "4", "5")]
    )


def random_lines(rng, n):
    def stamp():
        return f"2022-11-{rng.randint(10, 28)} 16:{rng.randint(10, 59)}:{rng.randint(10, 59)}"

    shapes = [
        lambda: f"{rng.randint(1, 9)},09{rng.randint(1, 9)},Ann,{stamp()}",
        lambda: f"{rng.randint(1, 9)},09{rng.randint(1, 9)},Bob,Ray,{stamp()}",
        lambda: f"{rng.randint(1, 9)},09{rng.randint(1, 9)},Cy",
        lambda: f"Dee,{stamp()}",
        lambda: f"Gil,{stamp()}",
        lambda: "tail,short text here",
        lambda: "",
        lambda: HEAD,
        lambda: "Customer Id",
        lambda: "just text",
    ]
    return [rng.choice(shapes)() for _ in range(n)]


@pytest.mark.parametrize("split_bytes", [None, 40, 150])
@pytest.mark.parametrize("mins", [(18, 10), (None, None)])
def test_random_files(read, split_bytes, mins):
    rng = random.Random(5)
    files = {f"f{i}.csv": random_lines(rng, rng.choice([1, 30, 80])) for i in range(3)}
    rows = repair.drop_empty(repair.drop_headers(repair.split_cells(read(files, split_bytes))), [*LOG.cells, LOG.spill])
    got = repair.repair_linebreak(repair.repair_delimiter(rows), LOG, *mins).select(*LOG.cells)
    want = [r for lines in files.values() for r in linebreak([delimiter(c) for c in kept(lines)], *mins)]
    assert bag(got.collect()) == bag(want)


def test_lines_and_cells_agree_on_what_is_data(read):
    extra = [HEAD + ",x,y", "Customer Id,Phone number", "Customer Id,other", "Customer Idx", "Customer Id,", "  ", HEAD + ","]
    lines = read({"a.csv": SAMPLE + extra})
    by_cells = repair.drop_empty(repair.drop_headers(repair.split_cells(lines)), [*LOG.cells, LOG.spill])
    by_lines = repair.split_cells(repair.data_lines(lines))
    assert bag(by_cells.collect()) == bag(by_lines.collect())


def pairs_of(rows):
    out, k = [], 0
    while k < len(rows):
        row = rows[k]
        if row[3] is None and k + 1 < len(rows):
            nxt = rows[k + 1]
            if nxt[0] is not None and not re.search(r"\d", nxt[0]) and nxt[1] is not None and STAMP.search(nxt[1]):
                out.append((*row[:4], *nxt[:4]))
                k += 2
                continue
        k += 1
    return out


@pytest.mark.parametrize("split_bytes", [None, 30, 90])
@pytest.mark.parametrize("tails", [False, True])
def test_pairs(read, split_bytes, tails):
    rng = random.Random(11)
    files = {f"f{i}.csv": random_lines(rng, 60) for i in range(3)}
    if tails:  # long runs of rows that are both halves
        files = {n: ["1,091,Cy"] * (i + 1) + ["Dee,2022-11-10 16:02:00"] * (17 + i) + lines for i, (n, lines) in enumerate(files.items())}
    rows = repair.drop_empty(repair.split_cells(read(files, split_bytes)), [*LOG.cells, LOG.spill])
    pairs = repair.detect_pairs(rows)
    got = pairs.select(*LOG.cells, *[f"next_{c}" for c in LOG.cells])
    want = [p for lines in files.values() for p in pairs_of([cells(line) for line in lines if line.strip(" ")])]
    assert bag(got.collect()) == bag(want)
    text = repair.pair_text(pairs).select("first_line", "second_line")
    join = lambda c: ",".join(v for v in c if v is not None)
    assert bag(text.collect()) == bag([(join(p[:4]), join(p[4:])) for p in want])


def records_of(lines):
    out, parts = [], []
    for line in (x.strip(" ") for x in lines):
        if not line:
            continue
        parts.append(line)
        if re.search(STAMP.pattern + "$", line):
            out.append((" ".join(parts), True))
            parts = []
    return out + ([(" ".join(parts), False)] if parts else [])


@pytest.mark.parametrize("split_bytes", [None, 30, 90])
def test_fragments(read, split_bytes):
    rng = random.Random(3)
    files = {f"f{i}.csv": random_lines(rng, 70) for i in range(3)}
    files["open.csv"] = ["only", "text", "here"]
    got = repair.join_fragments(read(files, split_bytes)).select("record", "complete")
    assert bag(got.collect()) == bag([r for lines in files.values() for r in records_of(lines)])


def test_good_rows_are_not_shuffled(read):
    plan = repair.clean_log(read({"a.csv": SAMPLE}))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "Window" in plan


def test_splits_are_really_small(read, spark):
    lines = read({"a.csv": SAMPLE * 5}, 40)
    assert lines.select("block").distinct().count() > 5
    assert lines.agg(F.count("*")).first()[0] == len(SAMPLE) * 5


@pytest.mark.parametrize("split_bytes", [None, 25, 80])
@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_multiline_csv_in_splits(spark, read, tmp_path, split_bytes, line_end):
    rng = random.Random(7)
    quoted = ["a", 'say "hi"', "x\ny", "\n\n", "1,2", "", "tail\n", '"\n"', "cr\rin", "crlf\r\nin", '"', '""']
    bare = ["b", '5" pipe', 'x"y"z', "", 'end"', " spaced "]
    rows = [[(w := rng.choice(quoted + bare), w in bare and rng.random() < 0.9 and w not in quoted) for _ in range(3)] for _ in range(60)]
    rows = [r for r in rows if any(w.strip() or not plain for w, plain in r)]
    cell = lambda w, plain: w if plain else '"' + w.replace('"', '""') + '"'
    text = ['"first\nname",b,c'] + [",".join(cell(*c) for c in row) for row in rows]
    lines = line_end.join(text).split("\n")
    read({"a.csv": lines, "b.csv": lines}, split_bytes)
    back = read_multiline_csv(spark, str(tmp_path / "in0"))
    assert back.columns == ["first\nname", "b", "c", "file_name"]
    want = [tuple(None if plain and w == "" else w for w, plain in row) for row in rows]
    for name in ("a.csv", "b.csv"):
        assert bag([tuple(r)[:3] for r in back.collect() if r["file_name"] == name]) == bag(want)
    ran = back._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert ran.count("FileScan text") <= 2


def test_an_unclosed_quote_keeps_all_text(spark, read, tmp_path):
    read({"a.csv": ["a,b", '1,5" pipe', "2,z", '3,"open', "4,w"]}, None)
    rows = [tuple(r)[:2] for r in read_multiline_csv(spark, str(tmp_path / "in0")).collect()]
    assert bag(rows) == bag([("1", '5" pipe'), ("2", "z"), ("3", "open\n4,w")])


@pytest.mark.parametrize(("line_end", "split_bytes"), [("\n", None), ("\r\n", 20)])
def test_blank_lines_before_the_heading(spark, read, tmp_path, line_end, split_bytes):
    read({"a.csv": line_end.join(["", " ", "a,b", "1,2", '"x\ny",z', ""]).split("\n"), "blank.csv": ["", ""]}, split_bytes)
    for columns in (None, ["a", "b"]):
        back = read_multiline_csv(spark, str(tmp_path / "in0"), columns)
        assert back.columns == ["a", "b", "file_name"]
        assert bag([tuple(r)[:2] for r in back.collect()]) == bag([("1", "2"), ("x\ny", "z")])


def test_plain_lines_are_not_moved(spark, read, tmp_path):
    """Neither for quoted text nor for fragments does a scan of text feed an exchange."""
    read({"a.csv": ["a,b", "1,2", '"x', 'y",3'] * 20}, 60)
    for frame in (read_multiline_csv(spark, str(tmp_path / "in0"), ["a", "b"]), repair.join_fragments(read({"a.csv": SAMPLE * 3}, 60))):
        frame.collect()
        ran = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert ran.count("FileScan text") == 1
        scan = ran[: ran.index("FileScan text")].rsplit("Union", 1)[1]
        on_the_way = [line for line in scan.split("\n") if "Exchange" in line and "Broadcast" not in line]
        assert not on_the_way


def test_broken_lines_are_found_in_one_scan(spark, read, monkeypatch):
    """Open rows and the edges of splits go to the scratch folder in one scan; the rest of a plan reads from there."""
    from lakeops.operators import lines as neighbours

    plans = []
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan text")
    written = neighbours.materialize
    monkeypatch.setattr(neighbours, "materialize", lambda df, name: plans.append(scans(df)) or written(df, name))
    assert scans(repair.clean_log(read({"a.csv": SAMPLE * 3}, 60))) + sum(plans) == 2
    plans.clear()
    cells = repair.split_cells(repair.data_lines(read({"a.csv": SAMPLE * 3}, 60)))
    assert (scans(repair.detect_pairs(cells)), plans) == (0, [1])


@pytest.mark.parametrize("stretch", [1, 2, 3, 1000])
def test_stretches_of_any_length(read, monkeypatch, stretch):
    from lakeops.operators import lines as neighbours

    lines = read({"a.csv": SAMPLE * 3, "b.csv": SAMPLE}, 50)
    want = bag([tuple(r) for r in repair.clean_log(lines).select(*[f"`{c}`" for c in LOG.cells]).collect()])
    pairs = bag([tuple(r)[2:] for r in repair.detect_pairs(repair.split_cells(repair.data_lines(lines))).collect()])
    monkeypatch.setattr(neighbours, "STRETCH", stretch)
    assert bag([tuple(r) for r in repair.clean_log(lines).select(*[f"`{c}`" for c in LOG.cells]).collect()]) == want
    assert bag([tuple(r)[2:] for r in repair.detect_pairs(repair.split_cells(repair.data_lines(lines))).collect()]) == pairs


@pytest.mark.parametrize("split_bytes", [None, 200])
def test_a_file_without_any_end_comes_in_pieces(read, split_bytes):
    lines = [f"line {k} without an end" for k in range(300)]
    got = repair.join_fragments(read({"open.csv": lines}, split_bytes), limit=500).orderBy("piece").collect()
    assert [r["piece"] for r in got] == list(range(len(got))) and not any(r["complete"] for r in got)
    assert " ".join(r["record"] for r in got) == " ".join(lines)
    assert len(got) > 10 and max(len(r["record"]) for r in got) < 1600


def test_long_records_among_short_ones(read):
    stamp = "2024-01-02 10:00:00"
    long = [f"part {k}" for k in range(100)]
    lines = [f"1 {stamp}", *long, f"end {stamp}", f"2 {stamp}"]
    got = repair.join_fragments(read({"f.csv": lines}, 90), limit=120).collect()
    assert {r["record"] for r in got if r["complete"]} == {f"1 {stamp}", f"2 {stamp}"}
    assert " ".join(r["record"] for r in sorted((r for r in got if not r["complete"]), key=lambda r: r["piece"])) == " ".join([*long, f"end {stamp}"])


def test_neighbours_are_sorted_by_stretches_not_splits(read, monkeypatch):
    from lakeops.operators import lines as neighbours

    monkeypatch.setattr(neighbours, "STRETCH", 3)
    wanted, edges = neighbours.gathered(neighbours.numbered(read({"a.csv": [f"l{i}" for i in range(20)]})), F.lit(True))
    seen = neighbours.with_next(wanted, edges, ["value"])
    assert ".stretch AS _w" in seen._jdf.queryExecution().optimizedPlan().toString()
    got = {r["value"]: r["_next"] and r["_next"]["value"] for r in seen.collect()}
    assert got == {f"l{i}": f"l{i + 1}" if i < 19 else None for i in range(20)}
