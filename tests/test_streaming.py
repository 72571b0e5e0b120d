"""Incremental screening stream: dedup across batches, scorer applied, idempotent folders."""

import csv

from prismark.schema import RECORD_FIELDS
from prismark.streaming.screening import screen_stream


def _write(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, fieldnames=RECORD_FIELDS)
        w.writeheader()
        for r in rows:
            w.writerow({k: r.get(k, "") for k in RECORD_FIELDS})


def test_screen_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    long_abs = "An abstract that is long enough to be screened."
    _write(src / "a.csv", [
        {"Source": "Google Scholar", "Title": "Family Needs", "Abstract": long_abs},
        {"Source": "PubMed", "Title": "family needs!", "Abstract": long_abs},
        {"Source": "PubMed", "Title": "Short one", "Abstract": "tiny"},
    ])
    q = screen_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), "criteria",
                      scorer=lambda p: '{"included": true, "reason": "fits"}')
    q.awaitTermination(120)
    _write(src / "b.csv", [{"Source": "Google Scholar", "Title": "FAMILY NEEDS", "Abstract": long_abs},
                           {"Source": "Google Scholar", "Title": "New title", "Abstract": long_abs}])
    q = screen_stream(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), "criteria",
                      scorer=lambda p: '{"included": false}')
    q.awaitTermination(120)
    out = {r.Title: (r.Source, r.Included, r.Screening_Reason, r.batch_id)
           for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert out["family needs!"] == ("PubMed", True, "fits", 0)
    assert out["Short one"][1:3] == (False, "No Abstract")
    assert out["New title"] == ("Google Scholar", False, "No reason provided", 1)
    assert len(out) == 3


def test_replayed_batch_keeps_its_rows(spark, tmp_path):
    from prismark.streaming.screening import process_batch

    out = str(tmp_path / "out")
    batch = spark.createDataFrame([("PubMed", "First title", "x" * 40), ("PubMed", "Second", "short")], "Source string, Title string, Abstract string")
    for _ in range(2):
        process_batch(batch, 0, out, "any")
        assert spark.read.parquet(out).count() == 2
    process_batch(batch, 1, out, "any")
    process_batch(batch, 0, out, "any")
    assert spark.read.parquet(out).count() == 2


def test_primary_rows_are_kept_whole_within_a_batch(spark, tmp_path):
    from prismark.streaming.screening import process_batch

    out = str(tmp_path / "out")
    rows = [("PubMed", "Same", "a"), ("PubMed", "same!", "b"), ("PubMed", "", "c"), ("PubMed", None, "d"),
            ("Google Scholar", "SAME", "e"), ("Google Scholar", "", "f"), ("Google Scholar", "Other", "g"), (None, "Third", "h")]
    process_batch(spark.createDataFrame(rows, "Source string, Title string, Abstract string"), 0, out, "any")
    assert sorted(r.Abstract for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d", "g", "h"]
    later = spark.createDataFrame([("PubMed", "SAME", "late"), ("PubMed", "", "no title")], "Source string, Title string, Abstract string")
    process_batch(later, 1, out, "any")
    assert [r.Abstract for r in spark.read.parquet(out).where("batch = 1").collect()] == ["no title"]
