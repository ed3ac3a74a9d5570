import json

import pytest

from tidemark import fixed
from tidemark.sources import landing
from tests.conftest import moment, rows

FULL = {
    "ask_contract_id": 1, "machine_id": 2, "host_id": 3, "dph_base": 0.5, "discounted_dph_total": 0.75, "min_bid": 0.1,
    "storage_total_cost": 0.01, "inet_up_cost": 0.001, "inet_down_cost": 0.002, "dlperf_per_dphtotal": 9.5,
    "gpu_arch": "nvidia", "gpu_name": "RTX 4090", "gpu_ram": 24564, "gpu_max_power": 450, "num_gpus": 2,
    "cuda_max_good": 12.4, "total_flops": 165.2, "gpu_mem_bw": 880.1, "cpu_arch": "amd64",
    "cpu_name": "AMD EPYC 7742 64-Core Processor", "cpu_cores_effective": 32.5, "cpu_ghz": 2.25, "cpu_ram": 128000,
    "disk_name": "nvme", "disk_space": 100.5, "disk_bw": 3000, "pci_gen": 4, "pcie_bw": 22.1, "inet_down": 800,
    "inet_up": 400, "reliability2": 0.99, "dlperf": 80.1, "geolocation": "Skopje, MK", "verification": "verified",
    "rentable": True, "rented": False,
}


def land(spark, *offers, offer_type="on_demand"):
    payload = json.dumps({"offers": list(offers)})
    df = spark.createDataFrame([(payload, offer_type, moment("2026-01-01T00:00:00"))],
                               "payload string, offer_type string, ingested_at timestamp")
    valid, rejects = landing.land_offers(df)
    return valid.collect(), rejects.collect()


def without(*keys, **changes):
    return {k: v for k, v in FULL.items() if k not in keys} | changes


def test_full_offer(spark):
    (row,), rejects = land(spark, FULL)
    assert not rejects
    assert row.asDict().keys() == {"ingested_at", *fixed.OFFER_FIELDS}
    assert (row.offer_id, row.total_price_usd_per_hr, row.gpu_price_usd_per_hr) == (1, 0.75, 0.5)
    assert (row.gpu_memory_mb, row.rentable_flag, row.rented_flag, row.offer_type) == (24564.0, True, False, "on_demand")


def test_defaults_only_for_absent_keys(spark):
    valid, rejects = land(spark, without("min_bid", "num_gpus"), without(min_bid=None), without(num_gpus=None))
    assert [(r.minimum_bid_price_usd, r.number_of_gpus) for r in valid] == [(0.0, 1), (None, 2)]
    assert [r.failed_rules for r in rejects] == ["number_of_gpus:required"]


@pytest.mark.parametrize(
    "offer, rules",
    [
        (without("gpu_name"), "gpu_model_name:required"),
        (without(gpu_name="  "), "gpu_model_name:required"),
        (without(verification="maybe"), "verification_flag:enum"),
        (without(host_id="x7"), "host_id:type"),
        (without(rented="perhaps", dph_base=None), "gpu_price_usd_per_hr:required,rented_flag:type"),
    ],
)
def test_rejects_name_their_reasons(spark, offer, rules):
    valid, rejects = land(spark, offer, FULL)
    assert len(valid) == 1 and [r.failed_rules for r in rejects] == [rules]


def test_optional_fields_may_be_missing(spark):
    optional = [key for key, _, needed in fixed.OFFER_FIELDS.values() if key and not needed]
    (row,), rejects = land(spark, without(*optional))
    assert not rejects and row.gpu_tdp_watts is None and row.minimum_bid_price_usd == 0.0


def test_unknown_offer_type_and_empty_payloads(spark):
    assert [r.failed_rules for r in land(spark, FULL, offer_type="auction")[1]] == ["offer_type:enum"]
    assert land(spark) == ([], [])
    df = spark.createDataFrame([("{}", "bid"), ("not json", "bid")], "payload string, offer_type string")
    valid, rejects = landing.land_offers(df.selectExpr("*", "current_timestamp() as ingested_at"))
    assert valid.count() == 0
    assert sorted((r.payload, r.failed_rules) for r in rejects.collect()) == [("not json", "payload:json"), ("{}", "payload:offers")]


def test_values_are_read_as_the_record_model_reads_them(spark):
    valid, rejects = land(
        spark, without(num_gpus=2.0, ask_contract_id=1.0), without(rented="off", rentable="on"), without(cpu_name="\u00a0\u2003"),
        without(cpu_name=7), without(num_gpus=2.5), without(gpu_name="\u00a0"),
    )
    assert [(r.offer_id, r.number_of_gpus, r.rentable_flag, r.rented_flag) for r in valid] == [(1, 2, True, False)] * 3
    assert valid[2].cpu_model_name is None
    assert [r.failed_rules for r in rejects] == ["cpu_model_name:type", "number_of_gpus:type", "gpu_model_name:required"]


def test_payload_is_parsed_once_per_row(spark):
    df = spark.createDataFrame([("{}", "bid")], "payload string, offer_type string")
    valid, _ = landing.land_offers(df.selectExpr("*", "current_timestamp() as ingested_at"))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json(StructField(ask_contract_id") == 1


def test_rates(spark):
    good = {"conversion_rates": {"USD": 1, "MKD": 52.61}, "time_last_update_utc": "Fri, 02 Jan 2026 00:00:01 +0000"}
    payloads = [good, {**good, "conversion_rates": {"EUR": 1}}, {**good, "time_last_update_utc": "soon"}, {}]
    df = spark.createDataFrame([(json.dumps(p), moment("2026-01-02T01:00:00")) for p in payloads], "payload string, ingested_at timestamp")
    valid, rejects = landing.land_rates(df)
    (row,) = valid.collect()
    assert (row.from_currency, row.to_currency, row.value, row.timestamp) == ("USD", "MKD", 52.61, moment("2026-01-02T00:00:01"))
    assert rejects.count() == 3


PAGE = """<html><table><tr><th>a</th><th>b</th></tr>
<tr class="x"><td>Домаќинства <b>ВТ1</b></td><td> 5,25 </td><td>-</td><td>01.01.2026</td></tr>
<TR><td>R &amp; D</td><td>1</td></TR><tr><th>h</th><td>2</td><td>-</td><td>01.01.2026</td></tr>
<tbody><tr><td>inner</td><td>1</td><td>2</td><td>3</td></tr></tbody></table></html>"""


def pages(spark, *texts, column="html"):
    return spark.createDataFrame([(t, moment("2026-01-01T00:00:00")) for t in texts], f"{column} string, ingested_at timestamp")


def test_html_table(spark):
    valid, rejects = landing.land_tiers(pages(spark, PAGE, "<p>no table</p>"))
    (row,) = valid.collect()
    assert (row.tariff_description, row.price_mkd_per_kwh, row.valid_from) == ("Домаќинства ВТ1", " 5,25 ", "01.01.2026")
    assert sorted(r.failed_rules for r in rejects.collect()) == ["tariff_description:required", "valid_from:required"]
    assert landing.html_table_rows(pages(spark, PAGE), direct_rows=False).filter("tariff_description = 'inner'").count() == 1


def test_html_items(spark):
    df = landing.html_list_items(pages(spark, "<ul><li>a  <i>b</i></li><li class='x'> c&nbsp;d\n</li></ul><li>open"))
    assert [(r.item_number, r.item_text) for r in df.collect()] == [(0, "a b"), (1, "c d")]


def test_schedule_gate(spark):
    shown = fixed.SCHEDULE_PAGE_TEXT
    assert landing.land_schedule(pages(spark, shown.replace(" ", " \n\t"), column="text")).count() == 31
    assert landing.land_schedule(pages(spark, shown.replace("13:00", "12:00"), column="text")).count() == 0


def test_stamp(spark):
    df = landing.snapshot_stamp(spark.range(3), "timestamp'2026-01-01 05:00:00'", "'poll-7'")
    assert rows(df.select("ingested_at", "poll_id").distinct()) == [(moment("2026-01-01T05:00:00"), "poll-7")]


@pytest.mark.parametrize("rented, read", [("oN", True), (" OFF ", False), ("FALSE", False), ("yes", True), ("ones", None)])
def test_booleans_in_other_forms(spark, rented, read):
    valid, rejects = land(spark, FULL | {"rented": rented})
    assert [r.rented_flag for r in valid] == ([] if read is None else [read])
    assert [r.failed_rules for r in rejects] == (["rented_flag:type"] if read is None else [])


def test_text_behind_escaped_quotes(spark):
    valid, rejects = land(spark, FULL | {"gpu_name": 'a "b"'}, FULL | {"gpu_name": 7, "geolocation": '"gpu_name":"x"'})
    assert [r.gpu_model_name for r in valid] == ['a "b"'] and [r.failed_rules for r in rejects] == ["gpu_model_name:type"]


def test_no_generated_method_is_too_large_to_be_compiled(spark):
    """HotSpot interprets methods above 8000 bytes; each offer then costs several times as much, whatever the session's settings."""
    payload = "payload string, offer_type string, ingested_at timestamp"
    for df in landing.land_offers(spark.createDataFrame([], payload).union(spark.range(1).selectExpr("'{}'", "'bid'", "now()"))):
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
        assert sizes and max(sizes) < 8000
