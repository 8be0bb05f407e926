"""Archive scan, manifest, plausibility, revision flags and file choice."""

import io
import os
import time
import zipfile

from pyspark.sql import functions as F

from waitband.config import raw_columns
from waitband.session import scratch_path
from waitband.sources import archives as AR


def _zip_bytes(members: dict) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_STORED) as z:
        for name, text in members.items():
            z.writestr(name, text)
    return buf.getvalue()


def _csv(rows):
    cols = ["Period", "Provider Org Code", "Total All"]
    return "\n".join([",".join(cols)] + [",".join(r) for r in rows]) + "\n"


def test_manifest_plausibility_revision_and_pick(spark):
    base = scratch_path(spark, "test-archives")
    local = base[len("file:"):] if base.startswith("file:") else base
    d = os.path.join(local, "raw", "rtt", "2025-26", "Jan26")
    os.makedirs(d)
    big = _csv([("RTT-January-2026", f"P{i:05d}", str(i)) for i in range(3000)])
    files = {
        "a_first.zip": _zip_bytes({"Jan26.csv": big}),
        "b_second.zip": _zip_bytes({"Jan26.csv": big.replace("P00001", "P99999")}),
        "c_revised.zip": _zip_bytes({"Jan26.csv": big}),
        "d_small.zip": _zip_bytes({"x.csv": "a\n1\n"}),
        "e_notzip.zip": b"x" * 20000,
        "f_nocsv.zip": _zip_bytes({"readme.txt": "y" * 30000}),
    }
    for i, (name, content) in enumerate(sorted(files.items())):
        with open(os.path.join(d, name), "wb") as f:
            f.write(content)
        os.utime(os.path.join(d, name), (time.time() + i, time.time() + i))
    m = AR.file_plausibility(AR.file_manifest(spark, f"{base}/raw"))
    rows = {r.filename: r for r in m.collect()}
    assert rows["a_first.zip"].success and rows["a_first.zip"].month_code == "Jan26"
    assert rows["a_first.zip"].financial_year == "2025-26"
    assert rows["a_first.zip"].csv_files_inside_zip == ["Jan26.csv"]
    assert rows["d_small.zip"].error_message.startswith("File too small")
    assert rows["e_notzip.zip"].error_message == "Not a valid ZIP file"
    assert rows["f_nocsv.zip"].error_message == "No CSV file inside archive"
    assert rows["a_first.zip"].raw_path == "raw/rtt/2025-26/Jan26/a_first.zip" and rows["a_first.zip"].source_url is None
    flagged = {r.filename: r.is_revised for r in AR.revised_flags(m).filter("success").collect()}
    assert flagged == {"a_first.zip": False, "b_second.zip": True, "c_revised.zip": True}
    picked = AR.pick_month_file(AR.revised_flags(m)).collect()   # files that failed are no choice
    assert [r.filename for r in picked] == ["c_revised.zip"]


def test_zip_scan_reads_first_csv_and_fills_missing_columns(spark):
    base = scratch_path(spark, "test-zipscan")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    with open(os.path.join(local, "m.zip"), "wb") as f:
        f.write(_zip_bytes({"b.CSV": _csv([("RTT-January-2026", "ABC", "7"), ("RTT-January-2026", "XYZ", "")]),
                            "a.txt": "ignored"}))
    df = AR.zip_csv_scan(spark, base, raw_columns())
    rows = df.select("Period", "Provider Org Code", "Total All", "Total", "_csv_member").collect()
    assert sorted((r["Provider Org Code"], r["Total All"]) for r in rows) == [("ABC", "7"), ("XYZ", None)]
    assert all(r["Total"] is None and r["_csv_member"] == "b.CSV" for r in rows)
    assert len(df.columns) == 121 + 3
    assert df.filter(F.col("_source_file").endswith("m.zip")).count() == 2


def test_expected_checksum_and_size(spark):
    rows = [("a.zip", 20000, "m1", True, ["x.csv"], "m1", 20000), ("b.zip", 20000, "m2", True, ["x.csv"], "m9", None),
            ("c.zip", 20000, "m3", True, ["x.csv"], None, 19999)]
    m = spark.createDataFrame(rows, "filename string, file_size_bytes bigint, md5_checksum string, is_zip boolean, "
                                    "csv_files_inside_zip array<string>, expected_md5 string, expected_size bigint")
    got = {r.filename: r.error_message for r in AR.file_plausibility(m).collect()}
    assert got == {"a.zip": None, "b.zip": "Checksum mismatch", "c.zip": "Size changed: 20000 bytes, expected 19999"}


def test_fixture_writer_refuses_object_storage(spark):
    import pytest

    from waitband.plans import fixtures as FX
    df = spark.createDataFrame([("a", "Jan26")], "x string, m string")
    with pytest.raises(ValueError, match="mounted shared folder"):
        FX.write_zip_archives(df, "s3a://bucket/out", "m", "s3a://bucket/csv")


def test_one_bad_archive_fails_alone_and_text_na_stays(spark):
    base = scratch_path(spark, "test-badzip")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    good = _zip_bytes({"a.csv": _csv([("RTT-January-2026", "NA", "7"), ("RTT-January-2026", "null", "")])})
    torn = bytearray(_zip_bytes({"b.csv": _csv([("RTT-January-2026", f"P{i}", "1") for i in range(4000)])}))
    torn[5000:5004] = b"####"
    for name, data in (("good.zip", good), ("torn.zip", bytes(torn)), ("no.zip", b"nothing"), ("empty.zip", _zip_bytes({"x.txt": "y"}))):
        with open(os.path.join(local, name), "wb") as f:
            f.write(data)
    rows = AR.zip_csv_scan(spark, base, raw_columns()).select("Provider Org Code", "Total All", "_source_file", "_scan_error").collect()
    assert sorted((r[0], r[1]) for r in rows if r._source_file.endswith("good.zip")) == [("NA", "7"), ("null", None)]
    errors = {r._source_file.split("/")[-1]: r._scan_error for r in rows if r._scan_error}
    assert set(errors) == {"torn.zip", "no.zip", "empty.zip"} and errors["empty.zip"] == "No CSV file inside archive"


def test_both_csv_readers_read_the_same(spark):
    from waitband.operators.load import read_raw_csv
    base = scratch_path(spark, "test-csv")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    rows = [("RTT-January-2026", "NA", "7"), ("RTT-January-2026", "ABC", ""), ("RTT-January-2026", "null", "*")]
    line = {c: "" for c in raw_columns()}
    text = "\n".join([",".join(raw_columns())] + [",".join((line | dict(zip(("Period", "Provider Org Code", "Total All"), r))).values()) for r in rows]) + "\n"
    with open(os.path.join(local, "m.csv"), "w") as f:
        f.write(text)
    with open(os.path.join(local, "m.zip"), "wb") as f:
        f.write(_zip_bytes({"m.csv": text}))
    plain = read_raw_csv(spark, f"{base}/m.csv").select(*[F.col(f"`{c}`") for c in raw_columns()])
    zipped = AR.zip_csv_scan(spark, base, raw_columns()).select(*[F.col(f"`{c}`") for c in raw_columns()])
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, zipped.collect()), key=str)
    assert {r[0] for r in plain.select("Provider Org Code").collect()} == {"NA", "ABC", "null"}


def test_mounted_archives_are_never_loaded_whole(spark):
    import contextlib
    base = scratch_path(spark, "test-piecewise")
    local = base[len("file:"):] if base.startswith("file:") else base
    os.makedirs(local)
    data = {"a b%20c#1.zip": _zip_bytes({"a.csv": _csv([("RTT-January-2026", "ABC", "7")])}), "no.zip": b"nothing"}
    for name, content in data.items():
        with open(os.path.join(local, name), "wb") as f:
            f.write(content)
    scan, manifest = AR.zip_csv_scan(spark, base, ["Total All"]), AR.file_manifest(spark, base)
    for df in (scan, manifest):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        read = [line for line in out.getvalue().splitlines() if line.startswith("ReadSchema")]
        assert len(read) == 1 and "path" in read[0] and "content" not in read[0]
    assert [r[0] for r in scan.filter("_scan_error is null").collect()] == ["7"]
    listed = spark.read.format("binaryFile").load(base).select("path", "modificationTime", "length", "content").toArrow()
    for make in (AR._probe_fn, lambda mounted: AR._unzip_fn(["Total All"], 1 << 20, mounted)):
        by_name, by_bytes = ([r for b in make(mounted)(listed.combine_chunks().to_batches()) for r in b.to_pylist()] for mounted in (True, False))
        assert by_name == by_bytes and len(by_name) == 2
    assert {r.filename: r.is_zip for r in manifest.collect()} == {"a b%20c#1.zip": True, "no.zip": False}


def test_archive_holds_every_part_once_under_one_header(spark):
    from waitband.plans import fixtures as FX
    base = scratch_path(spark, "test-packing")
    rows = spark.range(0, 40, 1, 5).selectExpr("cast(id as string) x", "case when id % 2 = 0 then 'Jan26' else 'Dec25' end m")
    FX.write_zip_archives(rows, f"{base}/out", "m", f"{base}/csv")
    local = FX.local_folder(base)
    assert len([f for f in os.listdir(f"{local}/csv/__m=Jan26") if f.endswith(".csv")]) == 5   # each task writes its own rows
    for month, first in (("Jan26", 0), ("Dec25", 1)):
        with zipfile.ZipFile(f"{local}/out/{month}/{month}_full.zip") as z:
            assert z.namelist() == [f"{month}.csv"]
            header, *body = z.read(f"{month}.csv").decode().splitlines()
        assert header == "x" and sorted(map(int, body)) == list(range(first, 40, 2))


def test_reader_holds_a_part_of_an_archive(tmp_path, monkeypatch):
    import inspect

    import pyarrow as pa
    rows = "".join(f"RTT-January-2026,P{i:05d},{i}\n" for i in range(100_000))
    text = "Period,Provider Org Code,Total All\n" + rows * 22   # 62 MB
    (tmp_path / "a.zip").write_bytes(_zip_bytes({"a.csv": text}))
    taken, read = [0], zipfile.ZipExtFile.read

    def counted(self, n=-1):
        out = read(self, n)
        taken[0] += len(out)
        return out

    monkeypatch.setattr(zipfile.ZipExtFile, "read", counted)
    listed = pa.RecordBatch.from_pydict({"path": [f"file:{tmp_path}/a.zip"]})
    block = inspect.signature(AR.zip_csv_scan).parameters["block_size"].default
    batches = AR._unzip_fn(["Total All"], block, True)([listed])
    n = next(batches).num_rows
    time.sleep(1)
    assert n and taken[0] < 40 << 20   # what is read ahead while the first batch is worked on
    assert n + sum(b.num_rows for b in batches) == 2_200_000 and taken[0] == len(text)


def test_a_load_without_one_sound_file_is_audited(spark):
    from waitband.operators.archive_load import load_archives
    from waitband.operators.load import load_summary
    base = scratch_path(spark, "test-nothing-sound")
    local = base[len("file:"):] if base.startswith("file:") else base
    torn = bytearray(_zip_bytes({"a.csv": _csv([("RTT-October-2025", f"P{i}", "1") for i in range(4000)])}))
    torn[5000:5004] = b"####"
    large = _zip_bytes({"a.csv": _csv([("RTT-January-2026", f"P{i}", "1") for i in range(9000)])})
    for month, data in (("Oct25", bytes(torn)), ("Jan26", large)):
        os.makedirs(os.path.join(local, "in", month))
        with open(os.path.join(local, "in", month, f"{month}.zip"), "wb") as f:
            f.write(data)
    audit = load_archives(spark, f"{base}/in", f"{base}/table", "2026-02-01", min_bytes=1_000, max_bytes=len(large) - 1)
    rows = {r.month_code: r for r in audit.collect()}
    assert {m: (r.chosen, r.success, r.rows_loaded) for m, r in rows.items()} == {"Oct25": (True, False, 0), "Jan26": (False, False, 0)}
    assert rows["Oct25"].error_message.startswith("BadZipFile") and rows["Jan26"].error_message.startswith("File too large")
    summary = load_summary(audit.filter("chosen"), "month_code").first()
    assert (summary.months, summary.failed, summary.total_rows) == (1, 1, 0)
    # the next load, within the limit, fills the same table
    again = load_archives(spark, f"{base}/in", f"{base}/table", "2026-02-01", min_bytes=1_000)
    assert {r.month_code: (r.success, r.rows_loaded) for r in again.collect()} == {"Oct25": (False, 0), "Jan26": (True, 9000)}
