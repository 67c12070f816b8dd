"""Runs that break and go on, and folders with damaged files."""

import gzip

import pytest
from test_runs import FILE, case

from helixframe.engine import parse
from helixframe.engine.settings import ParseSettings
from helixframe.sources import attempts, mmcif


def small(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_only_committed_attempts_count(spark, tmp_path):
    tries = attempts.Attempts(spark, str(tmp_path / "out"))
    assert tries.commits() == []
    with pytest.raises(ValueError, match="no committed run"):
        tries.read("a")
    broken = tries.begin()
    tries.write(broken, "a", small(spark, 1, 2))
    one = tries.begin()
    tries.write(one, "a", small(spark, 3))
    tries.write(one, "a", small(spark, 3, 4))  # a task's second try takes the place of the first
    tries.commit(one, ["a"], {"x": 1}, True, [])
    assert sorted(r.v for r in tries.read("a").collect()) == [3, 4]
    two = tries.begin()
    tries.write(two, "a", small(spark, 4, 5))
    assert sorted(r.v for r in tries.read("a").collect()) == [3, 4]
    with pytest.raises(ValueError, match="another run"):
        tries.commit(two, ["a"], {}, False, [])
    tries.commit(two, ["a"], {"x": 1}, False, [one])
    assert sorted(r.v for r in tries.read("a").collect()) == [3, 4, 4, 5] and sorted(r.v for r in tries.read("a", "v").collect()) == [3, 4, 5]
    three = tries.begin()
    tries.write(three, "a", small(spark, 9))
    tries.commit(three, ["a"], {}, True, [one, two])
    assert [r.v for r in tries.read("a").collect()] == [9] and [r["attempt"] for r in tries.commits()] == [three]


def test_scan_tells_damaged_files(spark, tmp_path):
    """A truncated gzip, a short loop, an open text value, no block at all, and a whole file: one row each."""
    whole = gzip.compress(FILE.encode())
    for name, raw in {
        "good.cif.gz": whole, "cut.cif.gz": whole[: len(whole) // 2], "loop.cif": b"data_x\n_entry.id X\nloop_\n_a.b\n_a.c\n1 2 3\n", "text.cif": b"data_x\n_entry.id\n;never\nends\n", "none.cif": b"# nothing\n", "junk.cif.gz": b"\x1f\x8bjunk",
    }.items():
        (tmp_path / name).write_bytes(raw)
    found = mmcif.scan(spark, str(tmp_path)).cache()
    told = {r.path.rsplit("/", 1)[1]: r.error for r in mmcif.files(found).collect()}
    assert set(told) == {"good.cif.gz", "cut.cif.gz", "loop.cif", "text.cif", "none.cif", "junk.cif.gz"} and told["good.cif.gz"] is None
    assert "EOFError" in told["cut.cif.gz"] and "has 3 values" in told["loop.cif"] and "no end" in told["text.cif"] and "no data block" in told["none.cif"] and told["junk.cif.gz"]
    assert {r.path.rsplit("/", 1)[1] for r in mmcif.whole(found).select("path").distinct().collect()} == {"good.cif.gz"}
    good = mmcif.scan(spark, str(tmp_path / "good.cif.gz"))
    assert sorted(map(str, mmcif.whole(found).collect())) == sorted(map(str, mmcif.whole(good).collect()))
    atoms = mmcif.category(mmcif.stored(good, str(tmp_path / "stored")), "atom_site", ["id", "Cartn_x"])
    assert "Exchange" not in atoms._jdf.queryExecution().executedPlan().toString() and atoms.count() > 2


def rows_of(tables):
    return {name: sorted(map(str, rows.select(*sorted(rows.columns)).collect())) for name, rows in tables.items() if name != "summary"}


def test_damaged_files_and_broken_runs(spark, tmp_path, monkeypatch):
    """One ok and two error rows; a run that breaks between tables, then goes on, gives what an unbroken one does."""
    source = case(spark, tmp_path)
    whole = gzip.compress(FILE.encode())
    (tmp_path / "cif" / "3bad.cif.gz").write_bytes(whole[:-200])
    (tmp_path / "cif" / "4bad.cif").write_text("data_x\nloop_\n_struct_asym.id\n_struct_asym.entity_id\nA\n")
    (tmp_path / "cif" / "1abc.cif.gz").unlink()
    settings = ParseSettings(min_polymer_chain_length=1, tight_multimer_min_buried_area=1.0)
    plain = parse.run(spark, source, str(tmp_path / "plain"), settings)
    results = {r.case_id: r for r in plain["results"].collect()}
    assert {k: r.status for k, r in results.items()} == {"2def": "ok", "3bad": "error", "4bad": "error"}
    assert results["3bad"].error and "has 1 values" in results["4bad"].error and results["2def"].error is None
    summary = plain["summary"].first()
    assert (summary.success_count, summary.failure_count, summary.total_cases) == (1, 2, 3)

    write, broken = attempts.Attempts.write, str(tmp_path / "broken")

    def breaks(self, attempt, table, rows, by=None):
        if table == "multimers":
            raise RuntimeError("lost")
        return write(self, attempt, table, rows, by)

    monkeypatch.setattr(attempts.Attempts, "write", breaks)
    with pytest.raises(RuntimeError, match="lost"):
        parse.run(spark, source, broken, settings)
    monkeypatch.undo()
    again = parse.run(spark, source, broken, settings, resume=True)
    assert rows_of(again) == rows_of(plain)
    # The files with errors are tried again, the others are left alone: mended, one is a result more.
    (tmp_path / "cif" / "3bad.cif.gz").write_bytes(gzip.compress((tmp_path / "cif" / "2def.cif").read_text().replace("2DEF", "3BAD").encode()))
    mended = parse.run(spark, source, broken, settings, resume=True)
    assert sorted((r.case_id, r.status) for r in mended["results"].collect()) == [("2def", "ok"), ("3bad", "ok"), ("4bad", "error")]
    assert mended["chains"].count() == 2 * again["chains"].count() and mended["interfaces"].count() == 2
    both = parse.merged_shards(spark, [broken, str(tmp_path / "plain")], str(tmp_path / "both"))
    assert rows_of(both) == rows_of(mended) and both["summary"].first().success_count == 2
