"""Readers, stores and streams on files made here."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from marlstone.sources import archives, contacts, packages, paged, records, registers, store
from marlstone.streaming import publish


def archive(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def test_archives_records_and_repairs(spark, tmp_path):
    text = "申请号,类别,日期,名称\n1001,9,2020-01-01,甲\n1002,9,2020-01-02,\"乙\n续行\n1003,35,2020-01-03,丙,丁\n1004,9\n"
    inner = archive({"表.csv": text.encode("gb18030")})
    (tmp_path / "2023_1.zip").write_bytes(archive({"inner.zip": inner}))
    lines = archives.read_lines(spark, str(tmp_path), terms=("申请号",))
    assert lines.count() == 6 and lines.first()["encoding"] == "gb18030"
    logical = records.logical_records(lines, F.col("line").rlike(r"^\d{4},\d+"))
    fixed = records.repaired_columns(logical.where("record > 0"), "text", ["no", "class", "day", "mark"], "mark")
    out = {r["no"] or r["text"][:4]: (r["mark"], r["repair"]) for r in fixed.collect()}
    assert out == {"1001": ("甲", "EXACT"), "1002": ("乙\n续行", "UNQUOTED"), "1003": ("丙,丁", "MERGED_VARIABLE"), "1004": (None, "UNREPAIRABLE")}
    profile = records.file_profile(lines, logical).first()
    assert (profile["physical_rows"], profile["logical_rows"], profile["continuation_rows"]) == (6, 4, 1)
    with pytest.raises(zipfile.BadZipFile):
        list(archives.members(b"no archive"))


def test_packages(spark, tmp_path):
    for name in ("2000.zip", "2023_1.zip", "apc19840101-20231231-07.zip", "apc240305.zip"):
        (tmp_path / name).write_bytes(name.encode())
    found = packages.discover(spark, str(tmp_path))
    none = spark.createDataFrame([], "sha256 string, file_name string, path string, file_size bigint, package_sequence bigint, status string")
    known = packages.register(none, found)
    assert sorted(r["package_sequence"] for r in known.collect()) == [1, 2, 3, 4]
    assert packages.register(known, found).count() == 4
    names = found.select("file_name", packages.describe(F.col("file_name"), "base_monthly").alias("b"), packages.describe(F.col("file_name"), "history_daily").alias("h"))
    by = {r["file_name"]: r for r in names.collect()}
    assert by["2000.zip"]["b"]["kind"] == "BASE" and str(by["2023_1.zip"]["b"]["period_end"]) == "2023-01-31"
    assert by["apc19840101-20231231-07.zip"]["h"]["part"] == 7 and str(by["apc240305.zip"]["h"]["period_start"]) == "2024-03-05"
    ranks = spark.createDataFrame([("BASE", "2000-01-01", 9), ("MONTHLY", "2000-01-01", 1), ("DAILY", "1999-01-01", 1), ("X", None, 1)], "k string, d string, s int")
    got = [r[0] for r in ranks.select(packages.rank(F.col("k"), F.col("d").cast("date"), F.col("s"))).collect()]
    assert got[3] < got[0] < got[1] < got[2]


def test_xml_register(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<all><case-file><serial-number>1</serial-number><owners><owner><name>A</name></owner><owner><name>B</name></owner></owners></case-file><case-file><serial-number>2</serial-number></case-file></all>")
    df = registers.read_xml(spark, str(tmp_path / "a.xml"), "case-file", "`serial-number` string, owners struct<owner:array<struct<name:string>>>")
    assert df.count() == 2
    out = registers.children(df.withColumnRenamed("serial-number", "serial"), ["serial"], "owners.owner", ["name"])
    assert sorted(map(tuple, out.collect())) == [("1", 1, "A"), ("1", 2, "B")]
    assert [r[0] for r in df.select(registers.first_of(df, "missing", "serial-number")).collect()] == ["1", "2"]


def test_delimited_register(spark, tmp_path):
    (tmp_path / "r.txt").write_text("No|Class1|Class2|Class9\n7|Y||x\n8|||\n")
    df = registers.read_delimited(spark, str(tmp_path / "r.txt"), "|")
    out = {r["No"]: r["c"] for r in df.select("No", registers.flagged_classes(df, ["Class1", "Class2", "Class9"]).alias("c")).collect()}
    assert out == {"7": [1, 9], "8": []}
    states = spark.createDataFrame([("k", 1, "UPDATE", "a"), ("k", 2, "DELETE", "b"), ("m", 1, "UPDATE", "c")], "k string, seq int, op string, v string")
    assert [tuple(r) for r in registers.ordered_current(states, "k", ["seq"], "op").select("k", "v").collect()] == [("m", "c")]
    with pytest.raises(Exception, match="share a place"):
        registers.ordered_current(states.unionAll(states), "k", ["seq"], "op").collect()


def test_contact_files(spark, tmp_path):
    sheet = '<worksheet><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>5</v></c></row></sheetData></worksheet>'
    files = {
        "a.csv": "公司名称;邮箱\n甲公司;a@b.test\n".encode("gb18030"), "b.jsonl": b'{"Company": "X", "Email": "x@y.test"}\n', "c.html": "<table><tr><th>Company</th><td>Phone</td></tr><tr><td>Y</td><td>123456</td></tr></table>".encode(),
        "d.xlsx": archive({"xl/sharedStrings.xml": "<sst><si><t>Company</t></si></sst>", "xl/worksheets/sheet1.xml": sheet}), "e.json": b"broken", "f.txt": "Company: Z\nEmail: z@z.test".encode(), "g.docx": archive({"word/document.xml": "<d><p><t>Hello</t></p></d>"}),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    cells = contacts.read_files(spark, str(tmp_path))
    by = {r["path"][-6:]: r for r in cells.orderBy(F.desc("row_no")).collect()}
    assert by["d.xlsx"]["cells"] == ["Company", "", "5"] and by["e.json"]["error"] and by["/f.txt"]["cells"] == ["Company", "Z"]
    out = {(r["path"][-6:], r["field"], r["value"]) for r in contacts.with_header(cells, {"ENTITY_NAME": ["Company", "公司名称"], "EMAIL": ["邮箱"], "PHONE": []}).collect()}
    assert ("/a.csv", "ENTITY_NAME", "甲公司") in out and ("/a.csv", "EMAIL", "a@b.test") in out and ("c.html", "PHONE", "123456") in out and (".jsonl", "EMAIL", "x@y.test") in out


def test_page_ledger(spark, tmp_path):
    assert paged.append_page(str(tmp_path), 1, {"items": [{"a": 1}, {"a": 2}]}) and not paged.append_page(str(tmp_path), 1, {"items": [{"a": 1}, {"a": 2}]})
    paged.append_page(str(tmp_path), 2, {"items": [{"a": 3}]})
    with pytest.raises(ValueError):
        paged.append_page(str(tmp_path), 2, {"items": []})
    spark.dataSource.register(paged.PageLedger)
    rows = spark.read.format("page_ledger").load(str(tmp_path)).collect()
    assert sorted((r["page"], json.loads(r["item"])["a"]) for r in rows) == [(1, 1), (1, 2), (2, 3)]


def test_store(spark, tmp_path):
    stage = str(tmp_path / "stage")
    df = spark.createDataFrame([("p1", 1), ("p2", 2)], "package_id string, v int")
    store.write_stage(df, stage)
    store.write_stage(df.where("package_id = 'p1'").withColumn("v", F.lit(9)), stage)
    assert sorted((r["package_id"], r["v"]) for r in spark.read.parquet(stage).collect()) == [("p1", 9), ("p2", 2)]
    store.drop_package(spark, stage, "package_id", "p1")
    assert spark.read.parquet(stage).count() == 1
    snap = str(tmp_path / "snap")
    assert store.current_snapshot(spark, snap) is None
    for version in (1, 2, 3):
        store.publish_snapshot(spark.range(version), snap, version)
    assert store.current_snapshot(spark, snap).count() == 3
    flat = str(tmp_path / "flat")
    spark.range(10).repartition(5).write.parquet(flat)
    store.compact(spark, flat, 1)
    assert spark.read.parquet(flat).count() == 10
    assets = store.store_assets(spark.createDataFrame([(bytearray(b"x"),), (bytearray(b"x"),), (None,)], "c binary"), "c", str(tmp_path / "assets"))
    assert assets.count() == 1
    store.export(spark.createDataFrame([(1, ["a"])], "x int, y array<string>"), str(tmp_path / "out"), "csv")
    assert spark.read.csv(str(tmp_path / "out"), header=True, escape='"').first()["y"] == '["a"]'


def test_tasks_that_store_one_content_at_once(spark, tmp_path):
    root = tmp_path / "assets"
    df = spark.range(0, 800, 1, 8).select(F.lit(bytearray(b"same" * 5000)).alias("c"))
    assert [r["storage_key"].count("/") for r in store.store_assets(df, "c", str(root)).collect()] == [2]
    files = [p for p in root.rglob("*") if p.is_file()]
    assert len(files) == 1 and files[0].read_bytes() == b"same" * 5000


def test_compaction_of_snapshots_and_after_a_break(spark, tmp_path):
    snap = str(tmp_path / "snap")
    store.publish_snapshot(spark.range(10).repartition(5), snap, 4)
    store.compact(spark, snap, 1)
    assert store.current_snapshot(spark, snap).count() == 10 and (tmp_path / "snap" / f"pointer-{5:020d}").exists()
    flat = tmp_path / "flat"
    spark.range(7).write.parquet(str(flat))
    flat.rename(tmp_path / "flat__old")  # a run that broke off between its two renames
    store.compact(spark, str(flat), 1)
    assert spark.read.parquet(str(flat)).count() == 7 and not (tmp_path / "flat__old").exists()


def test_stream_publishes_like_a_batch(spark, tmp_path):
    source, state, history = (str(tmp_path / n) for n in ("in", "state", "history"))
    schema = "k string, rank int, v string"
    for k, part in enumerate([[("a", 1, "x"), ("b", 5, "y")], [("a", 2, "z"), ("b", 4, "late")], [("c", 1, "n"), ("a", 2, "z")]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        publish.publish_stream(stream, state, history, str(tmp_path / "cp"), ["k"], "rank", {"v": "V_CHANGED"}).awaitTermination()
    assert sorted(map(tuple, store.current_snapshot(spark, state).select("k", "rank", "v").collect())) == [("a", 2, "z"), ("b", 5, "y"), ("c", 1, "n")]
    events = spark.read.parquet(history)
    assert [(r["k"], r["old_value"], r["new_value"]) for r in events.collect()] == [("a", "x", "z")]
    feed = publish.change_stream(spark, history, ", ".join(f"{c} {t}" for c, t in events.dtypes))
    query = feed.writeStream.format("memory").queryName("feed").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp2")).start()
    query.awaitTermination()
    assert spark.table("feed").count() == 1
    counts = publish.windowed_counts(events, "observed_at", "k", "1 day", "1 hour")
    assert [(r["k"], r["events"]) for r in counts.collect()] == [("a", 1)]


def test_key_value_text_and_batches(spark):
    df = spark.createDataFrame([(1, "Serial Number: 123\nE-mail：a@b.test\nemail: second@b.test\nnote without mark"), (2, None)], "id int, body string")
    out = registers.key_values(df, "body", {"serial_number": [], "email": ["e-mail"]}).orderBy("id").collect()
    assert [(r["serial_number"], r["email"]) for r in out] == [("123", "a@b.test"), (None, None)]
    rows, mark, seen = spark.range(25).select((F.col("id") % 3).alias("r"), F.col("id").alias("k")), None, []
    for _ in range(4):
        batch, mark = publish.next_batch(rows, ["r", "k"], mark, 10)
        seen += [tuple(r) for r in batch.orderBy("r", "k").collect()]
    assert seen == sorted((k % 3, k) for k in range(25)) and mark == seen[-1]


def test_read_functions(spark, data):
    from marlstone.plans import serve

    with pytest.raises(ValueError):
        serve.serial_number("12")
    one = serve.case_360(spark, data).where("owners is not null").first()["serial_number"]
    assert serve.case_360(spark, data, [one]).count() == 1 and serve.owners(spark, data, one).count() > 0
    assert serve.events(spark, data, one).count() >= 0 and serve.changes(spark, data, None, 5).count() == 5
    wrapped = serve.envelope(serve.owners(spark, data, one), "us", "owner", "1", ["serial_number", "owner_key"]).first()
    assert wrapped["subject"].startswith(one + "|") and json.loads(wrapped["payload"])["serial_number"] == one
    broken = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(Exception, match="without a subject"):
        serve.envelope(broken, "us", "x", "1", ["k"]).collect()


def test_layouts(spark, tmp_path):
    from marlstone.sources import layouts

    goods = "申请号,类,群,序,名称,状态\n10001,25,2501,1,衣,服,0\n10002,9,0901,2,软件,\n"
    people = "申请号,类,名,外,址,外址\n10001,25,甲,A,乙,B\n"
    (tmp_path / "2023_1.zip").write_bytes(archive({"商标商品服务信息.csv": goods.encode(), "商标注册人信息.csv": people.encode()}))
    out = {r["application_number"]: (r["goods_name"], r["goods_status_raw"], r["repair"]) for r in layouts.read_role(spark, str(tmp_path), "goods").collect()}
    assert out == {"10001": ("衣,服", "0", "MERGED_VARIABLE"), "10002": ("软件", "", "EXACT")}
    assert layouts.read_role(spark, str(tmp_path), "applicant").first()["owner_name_cn"] == "甲"
    case = "<r><case-file><serial-number>88991234</serial-number><case-file-header><status-code>630</status-code></case-file-header><case-file-owners><case-file-owner><party-name>A</party-name></case-file-owner></case-file-owners><case-file-event-statements><case-file-event-statement><code>NWAP</code><date>20240101</date></case-file-event-statement></case-file-event-statements></case-file></r>"
    (tmp_path / "c.xml").write_text(case)
    tables = layouts.read_cases(spark, str(tmp_path / "c.xml"))
    assert tables["case"].first()["status_code"] == "630" and tables["owner"].first()["party_name"] == "A" and tables["event"].first()["code"] == "NWAP" and tables["statement"].count() == 0
    entry = "<r><assignment-entry><assignment><reel-no>1</reel-no><frame-no>2</frame-no></assignment><assignees><assignee><person-or-organization-name>B</person-or-organization-name></assignee></assignees><properties><property><serial-no>88991234</serial-no></property></properties></assignment-entry></r>"
    (tmp_path / "a.xml").write_text(entry)
    tables = layouts.read_assignments(spark, str(tmp_path / "a.xml"))
    assert tuple(tables["assignee"].first())[:2] == ("1", "2") and tables["property"].first()["serial_no"] == "88991234" and tables["assignor"].count() == 0


def test_child_families_of_a_case(spark, tmp_path):
    from marlstone.sources import layouts

    (tmp_path / "c.xml").write_text(
        "<r><case-file><serial-number>88000001</serial-number><case-file-header><attorney-name>C. Dee</attorney-name></case-file-header><correspondent><address-1>Dee LLP</address-1></correspondent>"
        "<design-searches><design-search><code>010101</code></design-search><design-search><code>020202</code></design-search></design-searches>"
        "<prior-registration-applications><prior-registration-application><relationship-type>0</relationship-type><number>123</number></prior-registration-application></prior-registration-applications>"
        "<foreign-applications><foreign-application><entry-number>1</entry-number><country>DE</country></foreign-application></foreign-applications>"
        "<madrid-international-filing-requests><madrid-international-filing-record><entry-number>2</entry-number><reference-number>A1</reference-number><madrid-history-events><madrid-history-event><code>NEW</code><entry-number>1</entry-number></madrid-history-event></madrid-history-events></madrid-international-filing-record></madrid-international-filing-requests>"
        "</case-file><case-file><serial-number>88000002</serial-number></case-file></r>"
    )
    tables = layouts.read_cases(spark, str(tmp_path / "c.xml"))
    assert {n: t.count() for n, t in tables.items()} == {"case": 2, "owner": 0, "classification": 0, "event": 0, "statement": 0, "design": 2, "prior_registration": 1, "foreign_application": 1, "madrid_filing": 1, "correspondent": 1, "madrid_event": 1}
    assert tables["correspondent"].first()["attorney_name"] == "C. Dee" and tables["madrid_event"].first()["filing_reference_number"] == "A1"


def test_proceedings_in_three_layouts(spark, tmp_path):
    from marlstone.sources import proceedings

    (tmp_path / "1.xml").write_text(
        "<r><proceeding-entry><number>91 200001</number><type-code>OPP</type-code><filing-date>20240105</filing-date><status-code>5</status-code><party-information><party><identifier>7</identifier><role-code>P</role-code><name>Ada Co</name>"
        "<property-information><property><serial-number>88 000 001</serial-number><mark-text>ADA</mark-text></property></property-information></party></party-information>"
        "<prosecution-history><prosecution-entry><identifier>1</identifier><code>FILED</code><date>20240105</date><due-date>02/14/2024</due-date></prosecution-entry></prosecution-history></proceeding-entry>"
        "<proceeding-entry><number>none</number></proceeding-entry></r>"
    )
    (tmp_path / "2.xml").write_text(
        '<r><proceeding><proceeding-attributes><proceeding-number>91200002</proceeding-number><proceeding-type name="Opposition">OPP</proceeding-type><interlocutory-attorney><first-name>L</first-name><last-name>M</last-name></interlocutory-attorney></proceeding-attributes>'
        '<proceeding-parties><defendants><party name="Bo Ltd"><ttab-properties><ttab-property><serial-number>88000001</serial-number></ttab-property></ttab-properties></party></defendants></proceeding-parties>'
        '<prosecution-history><prosecution-history-event identifier="3" entry-date="2024-02-01" event-text="ANSWER"/></prosecution-history></proceeding></r>'
    )
    (tmp_path / "3.xml").write_text(
        "<r><proceeding-record><proceeding-number>92000003</proceeding-number><status-text>Open</status-text><plaintiff><party-name>Cy</party-name><property><serial-number>77</serial-number></property></plaintiff><history-entry><entry-number>1</entry-number><history-text>x</history-text></history-entry></proceeding-record>"
        "<proceeding-record><proceeding-number>91200001</proceeding-number><status-text>later</status-text></proceeding-record></r>"
    )
    tables = proceedings.read_proceedings(spark, str(tmp_path))
    heads = {r["number"]: (r["type"], r["type_code"], r["status"], r["attorney"], str(r["filing_date"])) for r in tables["proceeding"].collect()}
    assert heads == {"91200001": ("", "OPP", "", None, "2024-01-05"), "91200002": ("Opposition", "OPP", "", "L M", "None"), "92000003": (None, "", "Open", "", "None")}
    assert {(r["number"], r["side"], r["name"]) for r in tables["party"].collect()} == {("91200001", "ROLE_P", "Ada Co"), ("91200002", "DEFENDANT", "Bo Ltd"), ("92000003", "PLAINTIFF", "Cy")}
    assert {(r["number"], str(r["filing_date"]), str(r["due_date"])) for r in tables["docket"].collect()} == {("91200001", "2024-01-05", "2024-02-14"), ("91200002", "2024-02-01", "None"), ("92000003", "None", "None")}
    shot = {r["number"]: (r["parties"], r["properties"], r["entries"], str(r["next_due"])) for r in proceedings.proceeding_snapshot(tables).collect()}
    assert shot["91200001"] == (1, 1, 1, "2024-02-14")
    asked = spark.createDataFrame([("88000001",)], "serial_number string")
    assert {(r["number"], r["side"]) for r in proceedings.proceedings_of(tables, asked).collect()} == {("91200001", "ROLE_P"), ("91200002", "DEFENDANT")}


def test_case_360_holds_all_owners(spark, data, tmp_path):
    from marlstone.plans import serve

    owners = spark.range(120).selectExpr("'00000001' serial_number", "cast(id as string) owner_key", "'n' party_name", "'US' country", "1L source_rank", "id row_id", "if(id < 3, 1, 0) is_deleted")
    owners.write.parquet(f"{tmp_path}/us_owner_current.parquet")
    for name in ("us_event_history", "trademark_asset"):
        spark.read.parquet(f"{data}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    row = serve.case_360(spark, str(tmp_path)).first()
    assert len(row["owners"]) == row["n_owners"] == 117
    assert [tuple(r) for r in serve.QUERIES["case_360"](spark, str(tmp_path)).collect()] == [("00000001", 117, 0, None)]
