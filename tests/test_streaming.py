import datetime as dt
import os
import subprocess
import sys

from landing import land_pages

from gridlens.sources import store as S
from gridlens.streaming.page_stream import start_ingest_stream


def test_file_stream_upserts_landed_pages(spark, workdir):
    landing = os.path.join(workdir, "landing")
    rec = lambda h, v: {"period": f"2025-04-01T{h:02d}", "respondent": "CISO",
                        "respondent-name": "Cal", "type": "D", "type-name": "Demand",
                        "value": str(v)}
    land_pages(landing, [rec(0, 1), rec(1, 2), rec(0, 5)], page_size=2)
    data = os.path.join(workdir, "data")
    q = start_ingest_stream(spark, landing, data, "region", name="t_stream", checkpoint_location=os.path.join(workdir, "ck"),
                            ingested_at_utc=dt.datetime(2025, 5, 1, tzinfo=dt.UTC),
                            max_files_per_trigger=1)  # one page per micro-batch
    q.awaitTermination(120)
    rows = {r.period_utc.hour: r.value_mwh for r in S.scan_table(spark, data, "grid_region_hourly").collect()}
    assert rows == {0: 5.0, 1: 2.0}  # the later page (later micro-batch) wins for hour 0


def test_stream_resumes_from_its_checkpoint(spark, workdir):
    landing = os.path.join(workdir, "landing")
    rec = lambda h, v: {"period": f"2025-04-02T{h:02d}", "respondent": "CISO",
                        "respondent-name": "Cal", "type": "D", "type-name": "Demand",
                        "value": str(v)}
    land_pages(os.path.join(landing, "a"), [rec(0, 1)], page_size=1)
    data = os.path.join(workdir, "data")
    stamp = dt.datetime(2025, 5, 1, tzinfo=dt.UTC)
    start_ingest_stream(spark, landing + "/*", data, "region", name="t_resume", checkpoint_location=os.path.join(workdir, "ck"),
                        ingested_at_utc=stamp).awaitTermination(120)
    land_pages(os.path.join(landing, "b"), [rec(0, 7), rec(5, 3)], page_size=2)
    # a restarted query with the same name resumes from its checkpoint: only new files
    start_ingest_stream(spark, landing + "/*", data, "region", name="t_resume", checkpoint_location=os.path.join(workdir, "ck"),
                        ingested_at_utc=stamp).awaitTermination(120)
    rows = {r.period_utc.hour: r.value_mwh for r in S.scan_table(spark, data, "grid_region_hourly").collect()}
    assert rows == {0: 7.0, 5: 3.0}


def test_two_requests_in_one_micro_batch_resolve_by_folder(spark, workdir):
    landing = os.path.join(workdir, "landing")
    rec = lambda v: {"period": "2025-04-03T00", "respondent": "CISO",
                     "respondent-name": "Cal", "type": "D", "type-name": "Demand", "value": str(v)}
    # same key, same page offset in two request folders landed together
    land_pages(os.path.join(landing, "req-2025-05-01"), [rec(1)], page_size=1)
    land_pages(os.path.join(landing, "req-2025-05-02"), [rec(2)], page_size=1)
    data = os.path.join(workdir, "data")
    start_ingest_stream(spark, landing + "/*", data, "region", name="t_two_folders", checkpoint_location=os.path.join(workdir, "ck"),
                        ingested_at_utc=dt.datetime(2025, 5, 2, tzinfo=dt.UTC)).awaitTermination(120)
    rows = [r.value_mwh for r in S.scan_table(spark, data, "grid_region_hourly").collect()]
    assert rows == [2.0]  # the later request folder wins, every run


_PROGRAM = """
import sys
from gridlens.session import build_session
from gridlens.streaming.page_stream import start_ingest_stream
spark = build_session("local[2]", shuffle_partitions=2)
landing, data, check = sys.argv[1:]
start_ingest_stream(spark, landing + "/*", data, "region", checkpoint_location=check).awaitTermination(120)
"""


def test_a_new_process_resumes_and_keeps_a_later_correction(spark, workdir):
    landing, data, check = (os.path.join(workdir, x) for x in ("landing", "data", "check"))

    def rec(v):
        return {"period": "2025-04-04T00", "respondent": "CISO", "respondent-name": "Cal", "type": "D",
                "type-name": "Demand", "value": str(v)}

    def run():
        repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        subprocess.run([sys.executable, "-c", _PROGRAM, landing, data, check], check=True, timeout=240,
                       env=os.environ | {"PYTHONPATH": repo}, capture_output=True)

    land_pages(os.path.join(landing, "a"), [rec(1)], page_size=1)
    run()
    land_pages(os.path.join(landing, "b"), [rec(2)], page_size=1)
    run()
    run()  # reads nothing anew: the first page must not come back over the correction
    stored = S.scan_table(spark, data, "grid_region_hourly").collect()
    assert [r.value_mwh for r in stored] == [2.0]
