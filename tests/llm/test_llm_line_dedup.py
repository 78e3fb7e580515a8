"""Line dedup against plain Python."""

from collections import defaultdict

import pytest

from tillmart.llm import line_dedup
from tillmart.session import scratch_path

LONG = "A line that is long enough to be looked at, at least forty."


def plain(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(-1 if doc is None else doc)
    keeper = {k: max(docs) for k, docs in holders.items() if len(docs) >= 5}
    result = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(key(x), -1 if doc is None else doc) == (-1 if doc is None else doc)]
        result.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result, key=repr)


def rows():
    made = [(0, None), (1, ""), (2, "\n"), (3, "\n\n"), (None, LONG), (None, LONG + "\nx"), (4, LONG + "\r\nshort\n" + LONG)]
    made += [(n, f"own {n}\n \t{LONG.upper()}\x0b\n{LONG}\nend {n}\n") for n in range(5, 10)]
    made += [(n, "Four documents have this line only, it therefore stays put.") for n in range(10, 14)]
    made += [(n, "\u00a0" + LONG + "\u00a0") for n in range(14, 20)]  # not white space here
    made += [(20, "É" * 40), (21, "É" * 40), (22, "É" * 40), (23, "é" * 40), (24, "É" * 40), (25, "É" * 40)]
    made += [(26, "\n".join(f"{LONG} {n % 7}" for n in range(3000))), (27, f"{LONG} 3\n" * 2000)]
    made += [(n, f"{LONG} 3") for n in range(30, 34)]
    return made + [made[8], made[8], made[26]]


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_kept_lines(spark, batches):
    docs = spark.createDataFrame([(d, t, "en", 1) for d, t in rows()], "doc_id bigint, text string, key string, pos int")
    found = line_dedup.dedup_lines(spark, docs, batches)
    assert found.columns == [*docs.columns, "_kept", "_n_lines", "_n_dropped"]
    got = sorted(((r.doc_id, r._kept, r._n_lines, r._n_dropped) for r in found.collect()), key=repr)
    assert got == plain(rows())


def test_runs_are_compacted(spark):
    docs = spark.createDataFrame([(n, f"{LONG} {n % 3}") for n in range(30)], "doc_id bigint, text string")
    lines = line_dedup.line_hashes(docs)
    runs = line_dedup.LineRuns(spark, fanout=2)
    for n in range(5):
        runs.add(lines.where(f"doc_id % 5 = {n}"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    merged = runs.read().collect()
    assert sorted((r.documents, r.keeper) for r in merged) == [(10, 27), (10, 28), (10, 29)]


def test_batches_of_several_sessions(spark):
    """Each batch drops what the runs of all batches so far say, in whichever session they were added."""
    root = scratch_path(spark, "runs")
    text = "\n".join([LONG, "short", LONG + " again"])
    everything = []
    for n in range(7):
        docs = [(10 * n + k, text if k else LONG) for k in range(2)]
        everything += docs
        found = line_dedup.LineRuns(spark, root, fanout=3).dedup(spark.createDataFrame(docs, "doc_id bigint, text string"))
        wanted = [row for row in plain(everything) if row[0] >= 10 * n]
        assert sorted((tuple(r)[0], r._kept, r._n_lines, r._n_dropped) for r in found.collect()) == wanted
    assert [len(level) for level in line_dedup.LineRuns(spark, root).levels] == [1, 2]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.dedup_lines(spark, docs).collect() == []


def test_no_python(spark):
    docs = spark.createDataFrame([(1, LONG)], "doc_id bigint, text string")
    plan = line_dedup.dedup_lines(spark, docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _nodes(frame, spark):
    with line_dedup._sorted_files(spark):
        plan = frame._jdf.queryExecution().executedPlan().toString()
    return [name for name in ("Exchange", "Sort ", "SortMergeJoin", "BroadcastHashJoin") if name in plan]


def test_order_of_the_runs_is_used(spark):
    """Merging runs and joining a batch with them neither moves nor sorts a row, in a later session either."""
    docs = spark.createDataFrame([(n, f"{LONG} {n % 7}") for n in range(60)], "doc_id bigint, text string")
    lines = line_dedup.line_hashes(docs)
    root = scratch_path(spark, "runs")
    runs = line_dedup.LineRuns(spark, root)
    own = [runs.add(lines.where(f"doc_id % 3 = {n}")) for n in range(3)]
    for path in own:
        spark.sql(f"DROP TABLE line_run_{path.rsplit('-', 1)[1]}")  # what a new session knows
    later = line_dedup.LineRuns(spark, root)
    assert _nodes(later._pair(*later.levels[0][:2]), spark) == ["SortMergeJoin"]
    standing = later.standing(own[2], own[:2])
    assert _nodes(standing, spark) == ["SortMergeJoin"]
    assert sorted(map(tuple, standing.collect())) == sorted(map(tuple, later.read().collect()))


def test_other_number_of_shuffle_partitions(spark):
    """A store keeps its buckets, and its order, in a session of other settings."""
    docs = spark.createDataFrame([(n, f"{LONG} {n % 7}") for n in range(60)], "doc_id bigint, text string")
    lines = line_dedup.line_hashes(docs)
    root, name = scratch_path(spark, "runs"), "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    first = line_dedup.LineRuns(spark, root).add(lines.where("doc_id < 20"))
    try:
        spark.conf.set(name, "5")
        runs = line_dedup.LineRuns(spark, root)
        own = runs.add(lines.where("doc_id >= 20"))
        assert runs.buckets == int(before) and _nodes(runs.standing(own, [first]), spark) == ["SortMergeJoin"]
        assert sum(r.documents for r in runs.read().collect()) == 60
    finally:
        spark.conf.set(name, before)


def test_two_sessions_at_once(spark):
    root = scratch_path(spark, "runs")
    docs = spark.createDataFrame([(1, LONG)], "doc_id bigint, text string")
    one, two = line_dedup.LineRuns(spark, root), line_dedup.LineRuns(spark, root)
    one.dedup(docs)
    with pytest.raises(RuntimeError, match="batch 1"):
        two.dedup(docs)
    again = line_dedup.LineRuns(spark, root)
    with pytest.raises(Exception):
        again.add(docs)  # no line hashes: fails and gives its claim back
    again.dedup(docs)
    assert len(line_dedup.LineRuns(spark, root).levels[0]) == 2


def test_clashing_columns(spark):
    rows = [(n, f"own\n{LONG}", "a", "b", "c", 1, 2) for n in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _kept string, _stay string, _lines string, _N_LINES int, body int")
    found = line_dedup.dedup_lines(spark, docs)
    assert found.columns == ["doc_id", "text", "_stay", "_lines", "body", "_kept", "_n_lines", "_n_dropped"]
    got = sorted((r.doc_id, r._stay, r._lines, r.body, r._kept, r._n_dropped) for r in found.collect())
    assert got == [(n, "b", "c", 2, "own" if n < 4 else f"own\n{LONG}", int(n < 4)) for n in range(5)]


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{n}", LONG) for n in range(6)], "doc_id string, text string")
    got = sorted((r.doc_id, r._kept) for r in line_dedup.dedup_lines(spark, docs).collect())
    assert got == [(f"d{n}", LONG if n == 5 else "") for n in range(6)]
