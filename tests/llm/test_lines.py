"""op9 against SQL and brute force."""

import random
import re

from geots.llm import line_dedup, queries

from oracle import connect, same

SF = "/root/testdata/sf0.001"


def brute(docs: list[tuple]) -> dict:
    """doc_id -> (text, removed) for distinct ids: the first occurrence of a window stays."""
    seen: set = set()
    cuts: dict = {}
    for i, text in sorted(d for d in docs if d[0] is not None and d[1] is not None):
        lines = text.split("\n")
        cut = set()
        for k in range(len(lines) - 2):
            window = tuple(lines[k : k + 3])
            if not re.search(r"\S", "".join(window)):
                continue
            if window in seen:
                cut |= {k, k + 1, k + 2}
            seen.add(window)
        cuts[i] = ("\n".join(x for k, x in enumerate(lines) if k not in cut), len(cut)) if cut else (text, 0)
    return cuts | {i: (t, 0) for i, t in docs if t is None}


def test_sql(spark):
    db = connect(SF)
    same(queries.op9_line_dedup(spark, SF), db, queries.ORACLE_SQL["op9_line_dedup"])


def test_overlaps_and_runs(spark):
    rng = random.Random(2)
    docs = [(i, "\n".join(rng.choice(["a", "b", "", " ", "c d"]) for _ in range(rng.randrange(30)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "\n\n\n\n"), (503, "same\n" * 9), (504, "x"), (505, "p\nq\nr"), (506, "p\nq\nr")]
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id long, text string, cut string, h1 int").repartition(3)
    out = line_dedup.dedup_lines(df)
    assert {r["doc_id"]: (r["text"], r["lines_removed"]) for r in out.collect()} == brute(docs)
    assert out.columns == ["doc_id", "text", "cut", "h1", "lines_total", "lines_removed"]


def test_null_keys_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(0, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "d")]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb\nc")], "doc_id long, text string")
    assert not re.search("Python|Pandas|Arrow", line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString())
