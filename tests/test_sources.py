"""Sources: declared schemas, CSV backend, SQL files."""

from capstan.session import scratch_path
from capstan.sources import Sources
from capstan.sources.schemas import SCHEMAS

SF = "/root/testdata/sf0.001"


def test_derived_tables_conform_to_declared_schemas(spark):
    src = Sources.stored_fixtures(spark, SF)
    for name, ddl in SCHEMAS.items():
        declared = spark.createDataFrame([], ddl).schema
        got = src[name].schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared], name


def test_csv_sources_round_trip(spark):
    src = Sources.stored_fixtures(spark, SF)
    root = scratch_path(spark, "csv-sources")
    names = ["portal_part", "erp_po_line", "portal_task"]
    for n in names:
        src[n].write.option("header", True).csv(f"{root}/{n}")
    csv = Sources.csv(spark, root)
    for n in names:
        assert csv[n].schema == src[n].schema
        assert sorted(map(str, csv[n].collect())) == sorted(map(str, src[n].collect()))


def test_bucketed_layout_removes_the_line_shuffle(spark):
    """Lines and POs bucketed on PurchaseOrderID join without an exchange, with the same prices."""
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import pricing as pr
    from capstan.sources.layout import store_tables

    src = Sources.stored_fixtures(spark, SF)
    location = scratch_path(spark, "layout-db")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS capstan_layout_test LOCATION '{location}'")
    names = ["erp_po_line", "erp_po", "erp_part", "erp_supplier", "erp_currency"]
    bucketed = store_tables(src, "capstan_layout_test", names, buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")        # force the sort-merge join
        lines = pr.price_lines(bucketed, CFG)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        got = pr.open_po_prices(bucketed, CFG)
        assert sorted(map(str, got.collect())) == sorted(map(str, pr.open_po_prices(src, CFG).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lazy_and_stored_fixtures_give_the_same_report(spark):
    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import reports as rep
    lazy = rep.merged_capacity_cost(Sources.fixtures(spark, SF), CFG)
    stored = rep.merged_capacity_cost(Sources.stored_fixtures(spark, SF), CFG)
    assert lazy.columns == stored.columns
    assert sorted(map(str, lazy.collect())) == sorted(map(str, stored.collect()))


def _csv(spark, name, lines, files=1):
    root = scratch_path(spark, "csv-odd")
    header, *rows = lines
    # one file a part, each with its header
    for k in range(files):
        text = "\n".join([header, *rows[k::files]])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{root}/{name}")
    return Sources.csv(spark, root)


def test_csv_header_is_checked(spark):
    import pytest
    good = _csv(spark, "portal_supplier", ["SupplierID,SupplierCode,Name", "1,V1,One"])
    assert [tuple(r) for r in good["portal_supplier"].collect()] == [(1, "V1", "One")]
    swapped = _csv(spark, "portal_supplier", ["SupplierID,Name,SupplierCode", "1,One,V1"])
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        swapped["portal_supplier"].collect()
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        swapped["portal_supplier"].select("SupplierID").collect()


def test_csv_bad_rows_are_kept_aside(spark):
    import pytest
    lines = ["TagID,TagName,TagTypeID,Enabled", "1,a,1,1", "x,b,1,1", "3,c,1", "4,d,1,1,9", "5,,,", "6,f,one,0", '7,"g,h",2,1']
    for files in (1, 3):
        src = _csv(spark, "portal_tag", lines, files)
        assert sorted(map(tuple, src["portal_tag"].collect())) == [(1, "a", 1, 1), (5, None, None, None), (7, "g,h", 2, 1)]
        # the verdict does not depend on the columns that a query reads
        assert sorted(r.TagName or "" for r in src["portal_tag"].select("TagName").collect()) == ["", "a", "g,h"]
        assert src["portal_tag"].count() == 3 and src["portal_tag"].where("TagID > 2").count() == 2
        bad = src.rejected("portal_tag").collect()
        assert sorted(r.row for r in bad) == ["3,c,1", "4,d,1,1,9", "6,f,one,0", "x,b,1,1"] and all(r.file.startswith("file:") for r in bad)
        with pytest.raises(ValueError, match="portal_tag has rows that do not fit"):
            src.checked("portal_tag")
    fine = _csv(spark, "portal_tag", lines[:2])
    assert fine.checked("portal_tag").count() == 1 and fine.rejected("portal_tag").count() == 0


def test_sql_texts_over_two_sources_do_not_clash(spark):
    from pyspark.sql import functions as F

    from capstan.sources.files import run_sql
    src = Sources.stored_fixtures(spark, SF)
    other = Sources(spark, lambda n: src[n].where(F.col("SupplierID") < 3))
    text = "SELECT count(*) AS n, max(portal_supplier.SupplierID) AS m FROM portal_supplier;"
    a, b = run_sql(src, text, ["portal_supplier"]), run_sql(other, text, ["portal_supplier"])
    assert b.first().n == 3 and a.first().n == src["portal_supplier"].count() > 3 and a.first().n != b.first().n
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and "portal_supplier" in t.name]


def test_sql_parameters_are_values(spark):
    import pytest

    from capstan.sources.files import run_sql
    src = Sources.stored_fixtures(spark, SF)
    text = "SELECT SupplierID FROM portal_supplier WHERE SupplierCode = :code OR SupplierID = :id"
    sneaky = run_sql(src, text, ["portal_supplier"], {"code": "x' OR '1' = '1", "id": 2})
    assert [r[0] for r in sneaky.collect()] == [2]
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        run_sql(src, text, ["portal_supplier"], {"code": "x"})


def test_names_are_bound_outside_text_and_comments():
    from capstan.sources.files import bound_text
    text = """-- portal_task {here}
SELECT t.portal_task, 'portal_task {it''s}', `portal_task`, Portal_Task.x /* portal_task */ FROM portal_task, portal_tasks"""
    assert bound_text(text, ["portal_task"]) == """-- portal_task {{here}}
SELECT t.portal_task, 'portal_task {{it''s}}', `portal_task`, {portal_task}.x /* portal_task */ FROM {portal_task}, portal_tasks"""


def test_explosions_by_day_read_recent_folders_only(spark):
    """The newest explosion and the required parts: same rows, and files read do not grow with history."""
    from pyspark.sql import functions as F

    from capstan.config import FIXTURE_CONFIG as CFG
    from capstan.plans import pricing as pr
    from capstan.sources.layout import store_by_day
    src = Sources.stored_fixtures(spark, SF)
    old = src["erp_bom_explosion"]
    history = [old.withColumn("BOMExplosionDate", F.expr(f"TIMESTAMP_NTZ '1990-01-01 00:00:00' + INTERVAL {d} DAY")) for d in range(12)]
    longer = old
    for h in history:
        longer = longer.unionByName(h.limit(50))
    read = []
    for table in (old, longer):
        given = Sources(spark, lambda n, table=table: table if n == "erp_bom_explosion" else src[n])
        by_day = store_by_day(given, scratch_path(spark, "by-day"))
        for fn in (pr.bom_usage_latest, pr.recent_bom_parts):
            got, want = fn(by_day, CFG), fn(given, CFG)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 0
        usage = pr.bom_usage_latest(by_day, CFG)
        usage.collect()
        plan = usage._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(BOMExplosionDay" in plan and "BOMExplosionDay#" in plan
        read.append(_files_read(usage))
    assert read[0] == read[1] > 0


def _files_read(df):
    """Files that the partition filters of the plan's scans of explosions let through."""
    total = 0
    plan = df._jdf.queryExecution().executedPlan()
    todo = [plan]
    while todo:
        p = todo.pop()
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(p.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if "Scan parquet" in name and "BOMExplosionDate" in p.toString():
            total += p.metrics().apply("numFiles").value()
        children = p.children()
        todo += [children.apply(i) for i in range(children.size())]
        subs = p.subqueries()
        todo += [subs.apply(i) for i in range(subs.size())]
    return total
