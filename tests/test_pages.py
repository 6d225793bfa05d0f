import json
import os

from landing import land_pages

from gridlens.sources.pages import page_completeness, page_file_name, read_page_files, read_pages, request_slice


def test_pages_flatten_in_offset_order(spark, workdir):
    folder = os.path.join(workdir, "req")
    land_pages(folder, [{"period": str(i)} for i in range(5)], page_size=2)
    recs = read_pages(spark, folder, ["period"])
    ordered = [r.period for r in recs.withColumn("page_file", recs.file)
               .orderBy("file", "pos").collect()]
    assert ordered == ["0", "1", "2", "3", "4"]
    files = sorted(os.path.basename(r.file) for r in read_page_files(spark, folder, ["period"]).collect())
    assert [int(f.split("=")[1].split(".")[0]) for f in files] == [0, 2, 4]


def test_page_completeness(spark, workdir):
    full = os.path.join(workdir, "full")
    land_pages(full, [{"period": str(i)} for i in range(5)], page_size=2)
    short = os.path.join(workdir, "short")
    land_pages(short, [{"period": str(i)} for i in range(3)], page_size=2, total=7)
    empty = os.path.join(workdir, "empty")
    land_pages(empty, [{"period": str(i)} for i in range(2)], page_size=2, total=9)
    with open(os.path.join(empty, "offset=000000000002.json"), "w") as fh:
        fh.write('{"response": {"total": "9", "data": []}}')  # the API ran dry early
    stale = os.path.join(workdir, "stale")
    land_pages(stale, [{"period": str(i)} for i in range(8)], page_size=2)
    land_pages(stale, [{"period": str(i)} for i in range(3)], page_size=2)
    overlap = os.path.join(workdir, "overlap")  # records 0-1, 1-2 and a stray 6 of total 4: record 3 is missing
    for offset, n in ((0, 2), (1, 2), (6, 1)):
        os.makedirs(overlap, exist_ok=True)
        with open(os.path.join(overlap, page_file_name(offset)), "w") as fh:
            json.dump({"response": {"total": "4", "data": [{"period": str(offset + i)} for i in range(n)]}}, fh)
    pages = read_page_files(spark, workdir + "/*", ["period"])
    found = page_completeness(pages).collect()
    got = {os.path.basename(r.request): (r.landed, r.total, r.complete, r.loop_stopped) for r in found}
    more = {os.path.basename(r.request): (r.pages, r.stale_pages, r.missing, r.repeated) for r in found}
    assert got["full"] == (5, 5, True, True)
    assert got["short"] == (3, 7, False, False)  # the fetch loop would have asked for more
    assert got["empty"] == (2, 9, False, True)   # an empty page ends the loop short of total
    assert got["stale"] == (3, 3, True, True) and more["stale"] == (2, 2, 0, 0)
    assert not got["overlap"][2] and more["overlap"] == (3, 0, 3, 1)
    assert more["full"] == (3, 0, 0, 0)
    assert sorted(r.period for r in read_pages(spark, stale, ["period"]).collect()) == ["0", "1", "2"]


def test_request_slice_bounds_and_facets(spark):
    rows = [("2025-04-01T00", "CISO"), ("2025-04-30T23", "CISO"), ("2025-05-01T00", "CISO"),
            ("2025-04-02T05", "ERCO")]
    df = spark.createDataFrame(rows, "period string, respondent string")
    out = request_slice(df, start="2025-04-01T00", end="2025-04-30T23",
                        facets={"respondent": ["CISO"]}).collect()
    assert [r.period for r in out] == ["2025-04-01T00", "2025-04-30T23"]
