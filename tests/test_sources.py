"""Delimited files, archives and the raw zone, on small literal files."""

import datetime as dt
import io
import zipfile

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tickloom.operators.clean import clean_cancels, clean_ticks, dated, reject_ticks
from tickloom.operators.runs import requested_days
from tickloom.schemas import RAW_TICK_COLUMNS, SUMMARY, TICKS
from tickloom.sources import rawzone
from tickloom.sources.archives import read_zipped_ticks
from tickloom.sources.delimited import Layout, read_cancels, read_ticks
from tickloom.sources.files import list_files, locate
from tickloom.sources.tables import retype_summary
from tickloom.sources.textlines import after_first_line, first_line, text_blocks

HEADER = ",".join(RAW_TICK_COLUMNS)


def tick(comm="NK", clock="90501", code="T", day="20260529", price="38500.5", volume="3"):
    return f"{comm},F,M,2026,0,{clock},{code},{day},{price},{volume}"


def text(*lines, header=HEADER, end="\n"):
    return end.join([header, *lines]) + end


def archive(**members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for name, content in members.items():
            out.writestr(name.replace("_csv", ".csv"), content)
    return buffer.getvalue()


def cells_of(frame):
    return sorted(tuple(row) for row in frame.select(*RAW_TICK_COLUMNS).collect())


def test_repeated_header_and_empty_key(spark, folder):
    folder.put("in/a.csv", text(tick(), HEADER, tick(comm=""), tick(comm="NK ")))
    cleaned = clean_ticks(read_ticks(spark, f"{folder}/in"))
    assert [row.Symbol for row in cleaned.collect()] == ["NK", "NK"]
    assert cleaned.schema == TICKS


def test_bad_cells_become_null_and_rejects(spark, folder):
    folder.put("in/a.csv", text(
        tick(), tick(price="bad"), tick(volume="3.7"), tick(day="abc"), tick(day=""),
        tick(volume=" 7 "), tick(day=" 20260529"), tick(price=""),
    ))
    raw = read_ticks(spark, f"{folder}/in")
    good = dated(clean_ticks(raw))
    assert good.count() == 6
    assert good.where("TradePrice is null").count() == 2
    assert good.where("TradeVolume = 7").count() == 1
    reasons = sorted("|".join(row.reasons) for row in reject_ticks(raw).collect())
    assert reasons == ["Price", "Trade_Date|no trade date", "Volume", "no trade date"]


def test_two_column_orders_are_bound_by_name(spark, folder):
    names = ["Extra", *reversed(RAW_TICK_COLUMNS)]
    turned = ",".join(["x", *reversed(tick(comm="CN").split(","))])
    folder.put("in/a.csv", text(tick()))
    folder.put("in/b.csv", text(turned, header=",".join(names)))
    found = cells_of(read_ticks(spark, f"{folder}/in"))
    assert found == [tuple(tick(comm="CN").split(",")), tuple(tick().split(","))]


def test_missing_column_is_an_error(spark, folder):
    folder.put("in/a.csv", text("1,2", header="Comm,Price"))
    with pytest.raises(ValueError, match="lacks"):
        read_ticks(spark, f"{folder}/in")


def test_no_input_is_empty(spark, folder):
    assert read_ticks(spark, f"{folder}/nothing").isEmpty()
    assert read_ticks(spark, f"{folder}/nothing").columns == RAW_TICK_COLUMNS
    nothing = read_zipped_ticks(list_files(spark, f"{folder}/nothing", "*.zip"))
    assert nothing.rows.isEmpty() and nothing.errors.isEmpty()


def test_layout_names():
    layout = Layout('a, b ,"c,d",a,', ",")
    assert layout.names() == ["a", "b", "c,d", "a", ""]
    assert layout.schema().fieldNames() == ["a", "b", "c,d", "a_3", "_4"]
    assert layout.lacks(["A", "z"]) == ["z"]


def test_cancels_are_tab_separated_cents(spark, folder):
    header = (
        "Commodity\tContract_Type\tDelivery_Month\tDelivery_Year\tStrike_Price\tBusiness_Date\t"
        "Match_Time\tPrice_Indicator\tMessage_Code\tAmend_Code\tPrice\tVolume"
    )
    line = "NK \tF\tM\t2026\t0\t20260529\t90501\tP\tT\tC\t3850050\t4"
    folder.put("in/TC_20260529.txt", text(line, header, header=header))
    row = clean_cancels(read_cancels(spark, f"{folder}/in")).collect()
    assert len(row) == 1
    assert (row[0].Symbol, row[0].Price, row[0].Volume) == ("NK", 38500.5, 4)
    assert (row[0].TradeDate, row[0].TradeDateParsed) == ("20260529", dt.date(2026, 5, 29))


def test_archives_with_same_member_and_a_broken_one(spark, folder):
    folder.put("raw/1/a.zip", archive(t_csv=text(tick()), readme="not ticks"))
    folder.put("raw/2/b.zip", archive(t_csv=text(tick(comm="CN"), end="\r\n")))
    whole = archive(t_csv=text(*[tick()] * 2000), u_csv=text(tick(comm="XX")))
    folder.put("raw/3/c.zip", whole[: len(whole) // 2])
    damaged = bytearray(archive(t_csv=text(*[tick(comm="YY")] * 500), u_csv=text(tick())))
    damaged[60] ^= 255  # inside the first member's data: only its checksum tells
    folder.put("raw/4/d.zip", bytes(damaged))
    folder.put("raw/5/e.zip", archive(readme="nothing"))
    folder.put("raw/6/f.zip", archive(t_csv="Comm,Price\nNK,1\n"))
    read = read_zipped_ticks(list_files(spark, f"{folder}/raw", "*.zip"))
    assert sorted(r.Comm for r in read.rows.collect()) == ["CN", "NK"]
    assert {r.member for r in read.rows.collect()} == {"t.csv"}
    bad = {r.path.rpartition("/")[2]: r.error for r in read.errors.collect()}
    assert set(bad) == {"c.zip", "d.zip", "e.zip", "f.zip"}
    assert "lacks" in bad["f.zip"]
    assert "BadZipFile" in bad["c.zip"] and "no member" in bad["e.zip"]


def test_members_of_one_name_in_one_archive(spark, folder):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out, pytest.warns(UserWarning):
        out.writestr("t.csv", text(tick(comm="A")))
        out.writestr("t.csv", text(tick(comm="B")))
    folder.put("a.zip", buffer.getvalue())
    read = read_zipped_ticks(list_files(spark, folder, "*.zip"))
    assert sorted(r.Comm for r in read.rows.collect()) == ["A", "B"]


def test_archive_rows_equal_unpacked_rows(spark, folder):
    lines = [tick(comm=f'"A,{i}"' if i % 3 else "B", clock=str(i)) for i in range(500)]
    content = text(*lines, "", "short,row")
    folder.put("csv/a.csv", content)
    folder.put("zip/a.zip", archive(a_csv=content))
    read = read_zipped_ticks(list_files(spark, f"{folder}/zip"))
    assert read.rows.count() == 501
    key = lambda row: [c or "" for c in row]
    unpacked = read_ticks(spark, f"{folder}/csv").collect()
    packed = read.rows.select(*RAW_TICK_COLUMNS).collect()
    assert sorted(map(tuple, packed), key=key) == sorted(map(tuple, unpacked), key=key)


def test_archives_with_two_layouts(spark, folder):
    turned = ",".join(reversed(tick(comm="CN").split(",")))
    folder.put("a.zip", archive(t_csv=text(tick())))
    folder.put("b.zip", archive(t_csv=text(turned, header=",".join(reversed(RAW_TICK_COLUMNS)))))
    read = read_zipped_ticks(list_files(spark, folder, "*.zip"))
    assert cells_of(read.rows) == [tuple(tick(comm="CN").split(",")), tuple(tick().split(","))]


def test_members_are_spread(spark, folder):
    folder.put("a.zip", archive(t_csv=text(*[tick(comm=f"A{i}") for i in range(3000)])))
    folder.put("b.zip", archive(t_csv=text(tick())))
    listing = list_files(spark, folder, "*.zip")
    read = read_zipped_ticks(listing)
    plan = read.rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REBALANCE_PARTITIONS_BY_COL") == 1
    assert read.rows.count() == 3001
    assert read.rows.select("Comm").distinct().count() == 3001


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from(["a", "é", "bc", "\n", "\r", "\r\n", ""]), max_size=40).map("".join),
    st.integers(1, 7),
)
def test_text_blocks_equal_splitting_the_whole(content, chunk):
    blocks = list(text_blocks(io.BytesIO(content.encode()), chunk))
    lines = [line for block in blocks for line in block.split("\n")]
    whole = content.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    if whole[-1] == "":
        whole.pop()
    assert lines == whole
    filled = [line for line in whole if line.strip()]
    after = [line for block in after_first_line(iter(blocks)) for line in block.split("\n")]
    assert [line for line in after if line.strip()] == filled[1:]


def test_first_line_skips_blank_lines_and_mark():
    assert first_line(io.BytesIO("\ufeffa,b\n1,2".encode())) == "a,b"
    assert first_line(io.BytesIO(b"\n \nx")) == "x"
    assert first_line(io.BytesIO(b"")) is None


def test_locate():
    for uri in ("/tmp/x", "file:/tmp/x", "file:///tmp/x"):
        assert locate(uri)[1] == "/tmp/x"


def test_completeness_and_manifest(spark, folder):
    for name in (
        "20260529/WEBPXTICK_DT_20260529.zip", "20260529/TC_20260529.txt",
        "20260529/TC_structure.dat", "20260601/WEBPXTICK_DT_20260601.zip", "20260601/other.txt",
    ):
        folder.put(f"raw/{name}", "x")
    days = requested_days(spark, first=dt.date(2026, 5, 29), last=dt.date(2026, 6, 2))
    listing = rawzone.raw_listing(spark, f"{folder}/raw", days)
    friday, monday, tuesday = dt.date(2026, 5, 29), dt.date(2026, 6, 1), dt.date(2026, 6, 2)
    complete = rawzone.completeness(listing)
    assert {r.job_date: r.complete for r in complete.collect()} == {friday: True, monday: False}
    ready = [r.job_date for r in rawzone.days_with(days, complete).collect()]
    assert sorted(ready) == [friday, monday]
    missing = [r.job_date for r in rawzone.days_missing(days, complete).collect()]
    assert sorted(missing) == [monday, tuesday]
    manifest = rawzone.landing_manifest(days, listing)
    assert manifest.count() == 12
    there = manifest.where("status = 'success'").select("job_date", "filename").collect()
    assert sorted(map(tuple, there)) == [
        (friday, "TC_20260529.txt"), (friday, "TC_structure.dat"),
        (friday, "WEBPXTICK_DT_20260529.zip"), (monday, "WEBPXTICK_DT_20260601.zip"),
    ]


def test_summary_types(spark):
    wide = "1" * 30 + ".0001"
    row = ("2026-05-29", "NK", "T", "09", "5", "2", wide, "1.5")
    columns = ", ".join(f"{name} string" for name in SUMMARY.fieldNames())
    typed = retype_summary(spark.createDataFrame([row], columns))
    assert typed.schema == SUMMARY
    assert str(typed.first().GroupPriceVolume) == wide
    assert typed.first().Hour == "09"
