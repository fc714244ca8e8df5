import os
import time
from datetime import date, datetime, timedelta
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from supplyloom import session
from supplyloom.session import shared_folder
from supplyloom.sources import companies, mailbox, reports, runlog, tables


def test_company_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<companies>\n'
        "<Company><id>1</id><updated_at>2020-01-01 12:00:00</updated_at></Company>\n"
        "<Company><id>2</id><updated_at>2020-01-01 11:59:59</updated_at></Company>\n</companies>\n"
    )
    (tmp_path / "b.xml").write_text('<?xml version="1.0" encoding="UTF-8"?>\n<companies>\n</companies>\n')
    found = companies.read_companies_xml(spark, str(tmp_path), "id int, updated_at string", datetime(2020, 1, 2, 12))
    assert [r.id for r in found.collect()] == [1]
    assert companies.read_companies_xml(spark, str(tmp_path), "id int, updated_at string", datetime(2020, 1, 2, 12), days=2).count() == 2


def test_mailbox_page_and_first_attachment(spark):
    day = datetime(2020, 1, 2)
    box = [(day + timedelta(minutes=i), [f"f{i}", "x"] if i % 2 else []) for i in range(10)] + [(day - timedelta(days=1), ["old"]), (day, None)]
    mails = spark.createDataFrame(box, "sent timestamp_ntz, attachments array<string>")
    assert sorted(r.attachment for r in mailbox.todays_attachments(mails, date(2020, 1, 2)).collect()) == ["f1", "f3", "f5", "f7", "f9"]
    many = mails.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500))))
    assert mailbox.todays_attachments(many, date(2020, 1, 2)).count() == 2500


def test_attachment_files(spark, tmp_path):
    (tmp_path / "one.bin").write_bytes(b"abc")
    assert [bytes(r.content) for r in mailbox.attachment_files(spark, str(tmp_path)).collect()] == [b"abc"]


def test_content_of_attachments(spark, tmp_path):
    for folder, name, text in (("a", "one+1 ü.bin", b"old"), ("b", "one+1 ü.bin", b"abc"), ("b", "two.bin", b"")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(text)
    os.utime(tmp_path / "a" / "one+1 ü.bin", (1, 1))
    found = spark.createDataFrame([("one+1 ü.bin",), ("one+1 ü.bin",), ("two.bin",), ("three.bin",), (None,)], "attachment string")
    rows = mailbox.with_content(found, mailbox.attachment_files(spark, f"{tmp_path}/*")).collect()
    got = sorted((str(r.attachment), None if r.content is None else bytes(r.content), r.length) for r in rows)
    assert got == [("None", None, None), ("one+1 ü.bin", b"abc", 3), ("one+1 ü.bin", b"abc", 3), ("three.bin", None, None), ("two.bin", None, None)]


def test_empty_report_keeps_its_header(spark, tmp_path):
    df = spark.createDataFrame([], "a int, b string")
    path = reports.write_report(df, str(tmp_path / "empty"))
    assert [r.value for r in spark.read.text(path).collect()] == ["a,b"]
    bare = reports.write_report(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "bare"), header=False)
    assert [r.value for r in spark.read.text(bare).collect()] == ["1,x"]


def test_export_names_the_year(spark, tmp_path):
    df = spark.createDataFrame([(1, date(2019, 9, 30)), (2, date(2019, 10, 1))], "id int, d date")
    full, current = reports.export_full_and_fy(df, "d", str(tmp_path / "export"), date(2020, 5, 1))
    assert current.endswith("_2020")
    assert spark.read.option("header", True).csv(full).count() == 2
    assert [r.id for r in spark.read.option("header", True).csv(current).collect()] == ["2"]


def test_replace_append_and_log(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    assert tables.materialize(spark.range(5), path).count() == 5
    assert tables.materialize(spark.range(2), path).count() == 2
    rows = runlog.write_logged(spark.range(3), lambda df: tables.append_table(df, path), log, "load", datetime(2020, 1, 1))
    runlog.append_run_log(spark, log, "mail", {"sent": 4, "failed": 0}, 1.23456, datetime(2020, 1, 2))
    assert rows == 3 and spark.read.parquet(path).count() == 5
    entries = spark.read.parquet(log).orderBy("created_at").collect()
    assert [(e.category, e.message) for e in entries] == [("load", "rows: 3"), ("mail", "sent: 4\nfailed: 0")]
    assert entries[1].metrics == {"sent": 4, "failed": 0} and entries[1].elapsed_seconds == pytest.approx(1.235)


def test_checkpoints_use_one_folder(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_defaults_fit_a_session_made_elsewhere(spark):
    assert all(spark.conf.isModifiable(name) for name in session.DEFAULTS)
    assert not any(spark.conf.isModifiable(name) for name in session.START_DEFAULTS)
    other = spark.newSession()
    assert session.apply_defaults(other) is other


def test_append_rows_by_name(spark):
    both = tables.append_rows(spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(2,)], "k int"))
    assert sorted((r.k, r.v) for r in both.collect()) == [(1, "a"), (2, None)] and both.filter(F.col("v").isNull()).count() == 1


def shuffle_files(spark) -> set[str]:
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {b for b in blocks.split(",") if b.startswith("shuffle_")}


def test_staging_leaves_no_shuffle_files(spark):
    """Shuffle files of a staged table go with its job, without waiting for garbage collection of its plan."""
    before = shuffle_files(spark)
    kept = session.staged(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and kept.agg(F.sum("count")).first()[0] == 1_000
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) in (None, "false", "true")


def test_staged_tables_go_with_their_block(spark):
    """Blocks may stand in each other; a table may outlive its own."""
    made = []
    with session.passing():
        made.append(session.staged(spark.range(3)))
        with pytest.raises(OSError), session.passing():
            made += [session.staged(spark.range(4)), session.staged(spark.range(5), keep=1), session.staged(spark.range(6), keep=2)]
            places = [Path(urlparse(df.inputFiles()[0]).path).parent for df in made]
            raise OSError
        assert [p.exists() for p in places] == [True, False, True, True]
        assert made[2].count() == 5
    assert [p.exists() for p in places] == [False, False, False, True] and made[3].count() == 6


def test_shuffle_reads_are_cut_into_small_pieces(spark):
    """A task of p7 (F15) and of other sorts holds what 16 MB of shuffled rows unfold to, not what 64 MB do."""
    assert int(session.DEFAULTS["spark.sql.adaptive.advisoryPartitionSizeInBytes"].removesuffix("m")) <= 16
