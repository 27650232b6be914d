"""Invariants of the model graph (row conservation, shares, checks)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from pipewright.plans import Pipeline
from pipewright.plans.checks import check_summary
from pipewright.session import checkpoint_dir


@pytest.fixture(scope="module")
def pl(spark):
    return Pipeline.from_driver(spark, SF_MID)


def test_row_count_conserved_raw_to_ops(pl):
    n = pl.raw_leads.count()
    assert pl.stg_leads.count() == n == pl.entity_leads.count() == pl.ops_leads.count()
    m = pl.raw_opportunities.count()
    assert pl.entity_opportunities.count() == m == pl.ops_opportunities.count()


def test_dedupe_removes_duplicates(pl):
    assert pl.ingress_leads.count() > pl.raw_leads.count()
    assert pl.raw_leads.select("lead_id").distinct().count() == pl.raw_leads.count()
    # the version without created_date wins the opportunity dedupe (NULL first on DESC)
    winners = pl.raw_opportunities.filter(F.col("opportunity_id").cast("bigint") % 510 == 0)
    assert winners.filter(F.col("created_date").isNotNull()).count() == 0


def test_segments_add_up(pl):
    total = pl.ops_pipeline_health.count()
    assert pl.rpt_pipeline_health.agg(F.sum("record_count")).first()[0] == total


def test_channel_shares_sum_to_100(pl):
    for r in pl.rpt_channel_efficiency.groupBy("expense_month").agg(
            F.sum("pct_of_total_spend").alias("s"), F.sum("pct_of_total_leads").alias("l")).collect():
        assert abs(r.s - 100) <= 0.1 and abs(r.l - 100) <= 0.1


def test_check_summary(pl):
    got = {r.check_name: r.failures for r in check_summary(pl).collect()}
    # the source tables carry duplicates (the raw layer exists to remove them):
    # versions of leads and opportunities, and one ledger row exported twice
    assert got.pop("unique:ingress_leads.lead_id") > 0
    assert got.pop("unique:ingress_opportunities.opportunity_id") > 0
    assert got.pop("unique:ingress_expenses_advertising.month") == 1
    assert got.pop("unique:ingress_expenses_salary.month") == 1
    # dangling converted ids exist by construction of the fixture
    orphans = got.pop("referential_integrity_leads_to_opportunities")
    assert orphans >= 0
    assert all(v == 0 for v in got.values()), {k: v for k, v in got.items() if v}


def test_materialize_round_trip(spark, pl):
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-materialize"
    fresh = Pipeline.from_driver(spark, SF_MID)
    written = fresh.materialize(base, tables=("ops_leads", "ops_opportunities", "rpt_funnel_summary"))
    assert set(written) == {"ops_leads", "ops_opportunities", "rpt_funnel_summary"}
    a = sorted(tuple(r) for r in fresh.rpt_funnel_summary.collect())
    b = sorted(tuple(r) for r in pl.rpt_funnel_summary.collect())
    assert a == b


def test_materialize_again_and_in_part(spark, tmp_path):
    base = str(tmp_path / "tables")
    pl = Pipeline.from_driver(spark, SF_MID)
    first = pl.materialize(base, tables=("ops_leads", "ops_opportunities", "rpt_funnel_summary"))
    n = pl.ops_leads.count()
    again = pl.materialize(base, tables=("ops_leads", "ops_opportunities", "rpt_funnel_summary"))
    assert pl.ops_leads.count() == n and not set(first.values()) & set(again.values())
    pl.materialize(base, tables=("rpt_funnel_summary",))
    other = Pipeline.from_driver(spark, SF_MID)
    opened = other.open_tables(base)
    assert opened["ops_leads"] == again["ops_leads"] and opened["rpt_funnel_summary"] != again["rpt_funnel_summary"]
    assert sorted(map(tuple, other.rpt_funnel_summary.collect())) == sorted(map(tuple, pl.rpt_funnel_summary.collect()))


def test_failed_build_leaves_the_stored_tables(spark, tmp_path, monkeypatch):
    from pipewright.plans import reports

    base = str(tmp_path / "tables")
    pl = Pipeline.from_driver(spark, SF_MID)
    tables = ("ops_leads", "ops_opportunities", "rpt_funnel_summary")
    stored = pl.materialize(base, tables)
    n = pl.ops_leads.count()

    def broken(*args):
        raise RuntimeError("broken report")

    monkeypatch.setattr(reports, "rpt_funnel_summary", broken)
    with pytest.raises(RuntimeError):
        pl.materialize(base, tables)
    assert pl.ops_leads.count() == n and pl.rpt_funnel_summary.count() > 0
    assert Pipeline.from_driver(spark, SF_MID).open_tables(base) == stored


def _write_sources(spark, base, change=None):
    from pipewright.sources import Sources

    drv = Sources.from_driver(spark, SF_MID)
    frames = {"leads": drv.leads, "opportunities": drv.opportunities, "expenses_advertising": drv.expenses_advertising,
              "expenses_salary_and_commissions": drv.expenses_salary}
    for key, df in frames.items():
        (change(key, df) if change else df).write.parquet(f"{base}/{key}")
    return drv, {k: f"{base}/{k}" for k in frames}


def test_missing_source_column_is_an_error(spark, tmp_path):
    from pipewright.sources import Sources

    _, paths = _write_sources(spark, tmp_path, lambda key, df: df.drop("status"))
    with pytest.raises(ValueError, match="status"):
        Sources.from_parquet(spark, paths)


def test_integer_keys_are_accepted(spark, tmp_path):
    from pipewright.sources import Sources

    ids = ("lead_id", "converted_opportunity_id", "opportunity_id")
    change = lambda key, df: df.select(*[F.col(c).cast("long").alias(c) if c in ids else F.col(c) for c in df.columns])
    drv, paths = _write_sources(spark, tmp_path, change)
    a = Pipeline(spark, Sources.from_parquet(spark, paths)).rpt_funnel_summary.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, Pipeline(spark, drv).rpt_funnel_summary.collect()))


def test_checks_of_empty_tables_count_zero(spark):
    from pipewright.sources import Sources

    drv = Sources.from_driver(spark, SF_MID)
    empty = Sources(drv.leads.limit(0), drv.opportunities.limit(0), drv.expenses_advertising.limit(0), drv.expenses_salary.limit(0))
    assert all(r.failures == 0 for r in check_summary(Pipeline(spark, empty)).collect())


def test_queries_over_other_sources(spark, tmp_path, capsys):
    from pipewright.__main__ import main

    _write_sources(spark, tmp_path)
    assert main(["query", "--sources", str(tmp_path), "q24_row_counts"]) == 0
    assert main(["query", "--sources", str(tmp_path), "gen_share_events"]) == 2


def test_parquet_sources_path(spark):
    """Sources written as Parquet and read back with declared schemas give
    the same reports as the in-memory adapter."""
    from pipewright.sources import Sources, schemas

    base = f"{checkpoint_dir(spark).rstrip('/')}/test-sources"
    drv = Sources.from_driver(spark, SF_MID)
    paths = {}
    for key, df in (("leads", drv.leads), ("opportunities", drv.opportunities),
                    ("expenses_advertising", drv.expenses_advertising),
                    ("expenses_salary_and_commissions", drv.expenses_salary)):
        paths[key] = f"{base}/{key}"
        df.write.mode("overwrite").parquet(paths[key])
    src = Sources.from_parquet(spark, paths)
    n = len(schemas.LEADS.fields)
    assert [f.dataType for f in src.leads.schema.fields[:n]] == [f.dataType for f in schemas.LEADS.fields]
    assert tuple(src.leads.columns[n:]) == schemas.POSITION      # row position, for the dedupe ties
    a = Pipeline(spark, src).rpt_cac_ltv_by_channel.collect()
    b = Pipeline(spark, drv).rpt_cac_ltv_by_channel.collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_views_and_layer_schemas(spark):
    pl = Pipeline.from_driver(spark, SF_MID)
    pl.register_views(("ops_pipeline_health", "rpt_pipeline_health"))
    n = spark.sql("SELECT SUM(record_count) AS n FROM rpt_pipeline_health").first().n
    assert n == spark.sql("SELECT COUNT(*) AS n FROM ops_pipeline_health").first().n
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-catalog"
    written = pl.materialize(base, tables=("ops_expenses", "rpt_cac_ltv_by_channel"), schema_prefix="pw_test")
    assert "/operational/ops_expenses/run=" in written["ops_expenses"]
    assert spark.table("pw_test_reporting.rpt_cac_ltv_by_channel").count() == 2


def test_all_layers_by_name_from_another_session(spark, tmp_path):
    """Six databases with the layers' own names; every model reads as the pipeline computes it."""
    from helpers import canonical
    from pipewright.plans.pipeline import REPORT_TABLES, VIEW_MODELS
    from pipewright.plans.store import LAYERS, layer_of

    pl = Pipeline.from_driver(spark, SF_SMALL)
    want = {name: (pl.table(name).columns, pl.table(name).collect()) for name in VIEW_MODELS}
    pl.materialize(str(tmp_path), ("ops_leads", "ops_opportunities", "ops_pipeline_health", "rpt_funnel_summary"), "", view_layers=True)
    other = spark.newSession()
    assert {r.namespace for r in other.sql("SHOW DATABASES").collect()} >= set(LAYERS)
    for name, (columns, rows) in want.items():
        got = other.table(f"{layer_of(name)}.{name}")
        assert got.columns == columns and canonical(columns, got.collect()) == canonical(columns, rows), name
    assert other.table("reporting.rpt_funnel_summary").count() == 2 and len(REPORT_TABLES) == 6
    assert other.sql("SELECT count(*) AS n FROM raw.raw_leads r JOIN entity.entity_leads e USING (lead_id)").first().n == len(want["raw_leads"][1])


@pytest.mark.parametrize("fails", ["writing", "commit", "define"])
def test_readers_by_name_always_see_one_whole_build(spark, tmp_path, monkeypatch, fails):
    """A build that stops anywhere leaves the names on one build: the old one before the manifest, the new one after."""
    import dataclasses

    from pipewright.params import DEFAULT
    from pipewright.plans.store import Store

    names, prefix = ("ops_leads", "ops_opportunities", "ops_pipeline_health", "rpt_pipeline_health"), f"switch_{fails}"

    def read():
        other = spark.newSession()
        total = other.table(f"{prefix}_reporting.rpt_pipeline_health").agg(F.sum("avg_days_in_pipeline")).first()[0]
        return total, other.table(f"{prefix}_operational.ops_pipeline_health").agg(F.sum("days_in_pipeline")).first()[0]

    Pipeline.from_driver(spark, SF_SMALL).materialize(str(tmp_path), names, prefix)
    old = read()
    later = Pipeline.from_driver(spark, SF_SMALL, dataclasses.replace(DEFAULT, as_of="2024-08-30"))
    later.materialize(str(tmp_path / "apart"), names)
    new = (later.rpt_pipeline_health.agg(F.sum("avg_days_in_pipeline")).first()[0], later.ops_pipeline_health.agg(F.sum("days_in_pipeline")).first()[0])
    assert old != new

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    if fails == "writing":
        monkeypatch.setattr("pipewright.plans.reports.rpt_pipeline_health", stop)
    elif fails == "commit":
        monkeypatch.setattr(Store, "commit", stop)
    else:
        done = []
        sql = type(spark).sql

        def few(self, text, *args, **kwargs):
            done.append(text)
            return stop() if len([t for t in done if "CREATE OR REPLACE VIEW" in t]) > 2 else sql(self, text, *args, **kwargs)

        monkeypatch.setattr(type(spark), "sql", few)
    with pytest.raises(RuntimeError):
        Pipeline.from_driver(spark, SF_SMALL, dataclasses.replace(DEFAULT, as_of="2024-08-30")).materialize(str(tmp_path), names, prefix)
    monkeypatch.undo()
    assert read() == (new if fails == "define" else old)


def test_builds_are_read_by_their_run(spark, tmp_path):
    import dataclasses

    from pipewright.params import DEFAULT

    for day in ("2024-07-01", "2024-08-01"):
        Pipeline.from_driver(spark, SF_SMALL, dataclasses.replace(DEFAULT, as_of=day)).materialize(str(tmp_path), ("ops_pipeline_health",))
    pl = Pipeline.from_driver(spark, SF_SMALL)
    first, second = pl.runs(str(tmp_path))
    pl.open_tables(str(tmp_path), first)
    old = pl.ops_pipeline_health.agg(F.sum("days_in_pipeline")).first()[0]
    pl.open_tables(str(tmp_path), second)
    assert pl.ops_pipeline_health.agg(F.sum("days_in_pipeline")).first()[0] > old


def test_shared_frames_equal_the_layers(pl):
    """The shared rows are the rows of the layers, whichever way the key's row is picked."""
    from helpers import canonical
    from pipewright.plans import ops

    for shared, layer in ((pl.shared.ops_leads, pl.ops_leads), (pl.shared.entity_opportunities, pl.entity_opportunities),
                          (pl.shared.ops_opportunities, pl.ops_opportunities),
                          (ops.ops_pipeline_health(pl.shared.ops_opportunities, pl.shared.ops_leads, pl.p),
                           ops.ops_pipeline_health(pl.ops_opportunities, pl.ops_leads, pl.p))):
        columns = [c for c in layer.columns if c in shared.columns]
        assert set(layer.columns) - set(columns) <= {"marketplace_count", "marketplaces_used_raw", "online_ordering_count",
                                                     "online_ordering_used_raw", "cuisine_type_count", "cuisine_types_raw"}
        assert canonical(columns, shared.select(*columns).collect()) == canonical(columns, layer.select(*columns).collect())
    assert pl.shared.ops_leads.agg(F.sum("_rows")).first()[0] == pl.ingress_leads.count()


def test_shared_frames_without_positions(spark):
    """Hand-made frames have no row position: ties go by content, the same way in both forms."""
    from helpers import canonical, sources, ts

    leads = [{"lead_id": f"{i % 40}", "status": "Working", "sales_call_count": i, "cuisine_types": f"[{i}]"} for i in range(120)]
    opps = [{"opportunity_id": f"{i % 30}", "stage_name": "Interest", "account_id": str(i),
             "created_date": None if i % 7 == 0 else ts(f"2024-0{1 + i % 9}-01 10:00")} for i in range(150)]
    pl = Pipeline(spark, sources(spark, leads=leads, opps=opps))
    for shared, layer in ((pl.shared.ops_leads, pl.ops_leads), (pl.shared.entity_opportunities, pl.entity_opportunities)):
        columns = [c for c in layer.columns if c in shared.columns]
        assert canonical(columns, shared.select(*columns).collect()) == canonical(columns, layer.select(*columns).collect())


def test_checks_find_what_is_wrong(spark):
    """Duplicated, missing and dangling keys and contradictory deals are counted, each once."""
    import dataclasses

    from helpers import sources, ts

    leads = [{"lead_id": i, "status": "Working"} for i in ("a", "b", "b", "c", "none", "none")]
    leads += [{"lead_id": f"x{i}", "status": "Converted", "converted_opportunity_id": o} for i, o in enumerate(("o1", "gone", "gone", "away"))]
    opps = [{"opportunity_id": "o1", "stage_name": "Closed Won", "created_date": ts("2024-03-02 15:00")},
            {"opportunity_id": "o1", "stage_name": "Closed Won", "created_date": ts("2024-03-01 15:00")},
            {"opportunity_id": "none", "stage_name": "Interest"}]
    src = sources(spark, leads=leads, opps=opps, ad=[("Jan-24", "US$ 1,00"), ("Jan-24", "US$ 1,00")])
    missing = lambda df, key: df.withColumn(key, F.expr(f"nullif({key}, 'none')"))
    pl = Pipeline(spark, dataclasses.replace(src, leads=missing(src.leads, "lead_id"), opportunities=missing(src.opportunities, "opportunity_id")))
    got = {r.check_name: r.failures for r in check_summary(pl).collect()}
    wrong = {"unique:ingress_leads.lead_id": 1, "unique:ingress_opportunities.opportunity_id": 1,
             "not_null:raw_leads.lead_id": 1, "not_null:stg_leads.lead_id": 1, "not_null:entity_leads.lead_id": 1, "not_null:ops_leads.lead_id": 1,
             "not_null:raw_opportunities.opportunity_id": 1, "not_null:stg_opportunities.opportunity_id": 1,
             "not_null:entity_opportunities.opportunity_id": 1, "not_null:ops_opportunities.opportunity_id": 1,
             "not_null:rpt_lead_outreach_priority.lead_id": 1, "unique:ingress_expenses_advertising.month": 1,
             "closed_deals_have_close_date": 1, "referential_integrity_leads_to_opportunities": 3}
    assert {k: v for k, v in got.items() if v} == wrong


def test_cli_sql_and_query(spark, capsys):
    from pipewright.__main__ import main

    assert main(["sql", "--data", SF_MID, "SELECT COUNT(*) AS n FROM rpt_funnel_summary"]) == 0
    assert main(["query", "--data", SF_MID, "q24_row_counts"]) == 0
    out = capsys.readouterr().out
    assert "ops_pipeline_health" in out
    assert main(["explain", "--data", SF_MID, "gen_share_events"]) == 0
    assert main(["query", "--data", SF_MID, "no_such_query"]) == 2


def test_hot_opportunity_end_to_end(spark):
    """A third of all leads point at one opportunity: no fan-out, lowest lead wins."""
    from helpers import sources, ts

    leads = []
    for i in range(3000):
        lead = {"lead_id": f"{i:05d}", "status": "Converted" if i % 3 == 0 else "Working",
                "form_submission_date": ts("0024-03-01 10:00") if i % 2 else None,
                "predicted_sales_with_owner": "1000,00"}
        if i % 3 == 0:
            lead["converted_opportunity_id"] = "hot"
        leads.append(lead)
    opps = [{"opportunity_id": "hot", "stage_name": "Closed Won", "created_date": ts("2024-03-02 15:00"),
             "close_date": ts("0024-03-20 00:00").date()},
            {"opportunity_id": "cold", "stage_name": "Interest", "created_date": ts("2024-06-02 15:00")}]
    pl = Pipeline(spark, sources(spark, leads=leads, opps=opps))
    o = {r.opportunity_id: r for r in pl.ops_opportunities.collect()}
    assert len(o) == 2 and o["hot"].lead_id == "00000" and o["cold"].lead_id is None
    funnel = {r.channel: r for r in pl.rpt_funnel_summary.collect()}
    assert funnel["Outbound"].total_leads + funnel["Inbound"].total_leads == 3000
    assert funnel["Outbound"].converted_leads + funnel["Inbound"].converted_leads == 1000
    # the hot opportunity's lead (00000, no form) is outbound: the win lands there
    assert funnel["Outbound"].closed_won == 1
    assert pl.ops_pipeline_health.count() == 1 + 2000   # the open 'cold' deal + every working lead


def test_report_column_order(pl):
    from pipewright.plans import ops, reports

    expected = {
        "rpt_cac_ltv_by_channel": ["channel", "deals_won", "total_cost_6mo", "cac", "avg_monthly_subscription",
                                   "avg_monthly_take_rate", "avg_monthly_revenue", "avg_ltv_12mo", "avg_ltv_24mo",
                                   "avg_ltv_36mo", "ltv_to_cac_12mo", "ltv_to_cac_24mo", "ltv_to_cac_36mo"],
        "rpt_funnel_summary": reports.FUNNEL_COLUMNS,
        "rpt_monthly_unit_economics": reports.MONTHLY_COLUMNS,
        "rpt_channel_efficiency": reports.EFFICIENCY_COLUMNS,
        "rpt_pipeline_health": reports.PIPELINE_REPORT_COLUMNS,
        "rpt_lead_outreach_priority": reports.OUTREACH_COLUMNS,
        "ops_pipeline_health": ops.PIPELINE_COLUMNS,
    }
    sizes = {"rpt_cac_ltv_by_channel": 13, "rpt_funnel_summary": 31, "rpt_monthly_unit_economics": 24,
             "rpt_channel_efficiency": 28, "rpt_pipeline_health": 34, "rpt_lead_outreach_priority": 21,
             "ops_pipeline_health": 23}
    for name, cols in expected.items():
        assert pl.table(name).columns == list(cols), name
        assert len(cols) == sizes[name], name
    assert len(pl.ops_opportunities.columns) == 33


def test_cli_run_and_test(spark, capsys):
    from pipewright.__main__ import main

    base = f"{checkpoint_dir(spark).rstrip('/')}/test-cli-run"
    assert main(["run", "--data", "/root/testdata/sf0.001", "--out", base]) == 0
    out = capsys.readouterr().out
    assert f"{base}/operational/ops_leads/run=" in out and f"{base}/reporting/rpt_pipeline_health/run=" in out
    # the source tables carry duplicates by design, so the source-level checks fail
    assert main(["test", "--data", "/root/testdata/sf0.001"]) == 1
    out = capsys.readouterr().out
    assert "FAIL" in out and "unique:ingress_leads.lead_id" in out and "pass" in out
