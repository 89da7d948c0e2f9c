import os
import time

import pytest

from cladeframe.operators import census, profiles


@pytest.mark.parametrize("n, size", [(0, 3), (1, 3), (10, 3), (100, 7), (12, 12)])
def test_pages_follow_each_other(spark, n, size):
    rows = spark.range(n).selectExpr("id * 7 % 101 as k", "id").repartition(3)
    pages = profiles.Pages(rows, "k")
    want = sorted((i * 7 % 101, i) for i in range(n))
    got = [[tuple(r) for r in pages.page(p, size).collect()] for p in range(1, -(-n // size) + 1)]
    assert got == [want[i : i + size] for i in range(0, n, size)] and pages.total == n
    if n > size:
        assert [tuple(r) for r in pages.page(999, size).collect()] == got[-1] and [tuple(r) for r in pages.page("x", size).collect()] == got[0]
    assert [tuple(r) for r in profiles.page(rows, "k", 1, 0).collect()] == want


def test_a_page_reads_its_range_alone(spark):
    pages = profiles.Pages(spark.range(10_000).selectExpr("id"), "id", 4)
    part, n = pages.sizes[-1]
    last = pages.rows(9_990, 5)
    assert len(pages.sizes) > 1 and f"{part}" in last._jdf.queryExecution().optimizedPlan().toString() and [r.id for r in last.collect()] == list(range(9_990, 9_995))
    first = pages.sizes[0][1]
    assert [r.id for r in pages.rows(first - 2, 4).collect()] == list(range(first - 2, first + 2))


def test_counts_of_changed_files_alone(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "counts")

    def put(genome, name, n):
        (src / f"genome={genome}").mkdir(parents=True, exist_ok=True)
        (src / f"genome={genome}" / name).write_text("".join(f">s{i}\nAC\n" for i in range(n)))

    put("a", "x.fa", 3)
    put("a", "y.fa", 2)
    put("b", "x.fa", 4)
    (src / "genome=c+%23 d").mkdir()
    (src / "genome=c+%23 d" / "x+y z.fa").write_text("no head\n")
    run = lambda: (lambda df, n: ({r.genome: r.num_seqs for r in df.collect()}, n))(*census.refresh_counts(spark, str(src), table))
    assert run() == ({"a": 5, "b": 4, "c+%23 d": 0}, 4)
    assert run() == ({"a": 5, "b": 4, "c+%23 d": 0}, 0) and os.listdir(table).count("version=1") == 1
    time.sleep(0.01)
    put("a", "y.fa", 7)
    put("d", "z.fa", 1)
    os.remove(src / "genome=b" / "x.fa")
    assert run() == ({"a": 10, "c+%23 d": 0, "d": 1}, 2)
    os.makedirs(f"{table}/version=3/_temporary")  # what a killed run left
    put("d", "z.fa", 6)
    assert run() == ({"a": 10, "c+%23 d": 0, "d": 6}, 1) and run()[1] == 0
    os.remove(src / "genome=d" / "z.fa")
    assert run() == ({"a": 10, "c+%23 d": 0}, 0)
