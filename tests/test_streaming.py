import json
import os
import re

import pytest
from basketflow import schemas
from basketflow.streaming import ingest, router

EVENT = {"type": "event", "event_type": "view_page", "user_id": 7, "timestamp": "2024-01-01T00:00:00+00:00"}
MESSAGES = [
    EVENT,
    {**EVENT, "type": "session_start", "event_type": "ignored", "session_id": "s1"},
    {k: v for k, v in EVENT.items() if k != "type"},                 # no type: an event
    {**EVENT, "type": None},                                          # null type: an event too
    {**EVENT, "type": "something_new", "quantity": "3", "cost_usd": 1.239},
    {"type": "user_profile", "user_id": 7, "name": "A", "birth_date": "2000-01-02", "extra": [1]},
    {"type": "user_device", "user_id": "7", "os": "iOS"},
    {"type": "user_location", "user_id": 7, "lat": 1.5, "lon": "2.5", "weather_temp": 9},
    {"type": "order", "order_id": "o1", "user_id": 7, "total_usd": 5, "campaign_id": "c"},
    {"type": "order_item", "order_id": "o1", "product_id": 3, "quantity": 2, "price_usd": 2.5},
    {"type": "campaign_event", "user_id": 7, "campaign_id": "c", "cost": 1},
    {"type": "order_status", "order_id": "o1", "status": "success"},
]
BAD = ['{"type": "event", "user_id"', "[1, 2]", "17", "null", "",
       json.dumps({**EVENT, "quantity": "many"}), json.dumps({"type": "event", "user_id": 7}),
       json.dumps({"type": "order_status", "status": "success"}),
       json.dumps({"type": "order_status", "order_id": "o1", "status": "lost"}),
       json.dumps({"type": "user_profile", "birth_date": "soon"})]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_routes(spark):
    tables = router.route(frame(spark, map(json.dumps, MESSAGES)))
    counts = {name: df.count() for name, df in tables.items()}
    assert counts == {"events": 5, **{t: 1 for t in schemas.RAW if t != "events"}, "quarantine": 0}
    events = tables["events"].collect()
    assert sorted(r.event_type for r in events) == ["session_start"] + ["view_page"] * 4
    assert {(r.quantity, str(r.cost_usd)) for r in events if r.quantity} == {(3, "1.24")}
    assert tables["orders"].columns == ["order_id", "user_id", "order_ts", "total_usd"]
    place = tables["user_locations"].first()
    assert (place.user_id, place.lat, place.lon) == ("7", 1.5, 2.5)


def test_bad_messages_are_kept_with_reason(spark):
    tables = router.route(frame(spark, BAD))
    kept = tables["quarantine"].collect()
    assert sorted(r.value for r in kept) == sorted(BAD)
    assert sorted(r.reason for r in kept) == sorted(
        ["not a JSON object"] * 5 + ["quantity: not a int", "timestamp: missing", "order_id: missing",
                                     "status: unknown", "birth_date: not a date"])
    assert sum(tables[t].count() for t in schemas.RAW) == 0


def test_only_whole_objects_are_read(spark):
    order = json.dumps({"type": "order", "order_id": "o4", "user_id": "7", "order_ts": "2024-01-02T03:04:05", "total_usd": 1})
    item = json.dumps({"type": "order_item", "order_id": "o4", "product_id": 5.0, "quantity": 2.0, "price_usd": 1})
    bad = [order + " trailing", order + item, order + "," + item, order + "]", order + "}", f"[{order}]", "null"]
    tables = router.route(frame(spark, ["\n\t" + order, order + "\r\n ", item, *bad]))
    assert tables["orders"].count() == 2
    assert [(r.product_id, r.quantity) for r in tables["order_items"].collect()] == [(5, 2)]
    assert sorted(r.value for r in tables["quarantine"].collect()) == sorted(bad)


def test_fail_mode(spark):
    good = router.route(frame(spark, [json.dumps(EVENT)]), on_bad="fail")
    assert good["events"].count() == 1
    with pytest.raises(Exception, match="bad message"):
        router.route(frame(spark, BAD[:1]), on_bad="fail")["events"].collect()


def write_lines(path, name, texts):
    """A message file appears whole, as the stream source requires."""
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/.{name}", "w", encoding="utf-8") as out:
        out.write("\n".join(texts) + "\n")
    os.rename(f"{path}/.{name}", f"{path}/{name}")


def drain(spark, base, **options):
    stream = ingest.read_events_stream(spark, f"{base}/in", "text", batch_size=1)
    ingest.start_ingest(stream, f"{base}/raw", f"{base}/checkpoint", **options).awaitTermination()
    return ingest.read_landed(spark, f"{base}/raw")


def test_stream_equals_batch_and_restart_adds_nothing(spark, rows, tmp_path):
    base, texts = str(tmp_path), [json.dumps(m) for m in MESSAGES]
    write_lines(f"{base}/in", "a.json", texts[:6] + BAD[:4])
    write_lines(f"{base}/in", "b.json", texts[6:])
    landed = drain(spark, base)
    assert landed.select("batch_id").distinct().count() == 2
    batch = router.route(frame(spark, texts))
    for table, df in batch.items():
        if table != router.QUARANTINE:
            got = ingest.read_raw(spark, f"{base}/raw", table)
            assert got.schema == schemas.RAW[table]
            assert rows(got.select(*df.columns)) == rows(df)
    assert drain(spark, base).count() == len(texts) + 4
    write_lines(f"{base}/in", "c.json", texts[:1])
    assert drain(spark, base).count() == len(texts) + 5
    assert landed.select("serial").distinct().count() == len(texts) + 4


def test_repeated_batch_lands_once(spark, tmp_path):
    base = f"{tmp_path}/raw"
    land, batch = ingest.append_raw(base), frame(spark, map(json.dumps, MESSAGES))
    land(batch, 0)
    first = sorted(map(str, ingest.read_landed(spark, base).drop("received_at").collect()))
    land(batch, 0)
    assert sorted(map(str, ingest.read_landed(spark, base).drop("received_at").collect())) == first
    land(batch, 1)
    assert ingest.read_landed(spark, base).count() == 2 * len(MESSAGES)


def test_lost_progress_is_replayed_without_doubles(spark, tmp_path):
    """The sink wrote batch 1 but its commit was lost: the batch runs again."""
    base = str(tmp_path)
    write_lines(f"{base}/in", "a.json", [json.dumps(m) for m in MESSAGES])
    write_lines(f"{base}/in", "b.json", [json.dumps(m) for m in MESSAGES])
    before = drain(spark, base).count()
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{base}/checkpoint/commits/{name}"):
            os.remove(f"{base}/checkpoint/commits/{name}")
    assert drain(spark, base).count() == before == 2 * len(MESSAGES)


def test_fail_mode_stops_the_stream(spark, tmp_path):
    base = str(tmp_path)
    write_lines(f"{base}/in", "a.json", BAD[:1])
    with pytest.raises(Exception, match="bad message"):
        drain(spark, base, on_bad="fail")


def test_read_raw_prunes_folders_and_columns(spark, tmp_path):
    base = f"{tmp_path}/raw"
    ingest.append_raw(base)(frame(spark, map(json.dumps, MESSAGES)), 0)
    plan = ingest.read_raw(spark, base, "orders").select("order_id")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "(route" in plan.split("PartitionFilters")[1] and "ReadSchema: struct<order_id:string>" in plan


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.read_events_stream(spark, "user_events", kafka__bootstrap__servers="localhost:1")
    with pytest.raises(ValueError):
        ingest.read_events_stream(spark, "x", "csv")


def test_code_of_a_row_is_compiled_and_checks_are_not_repeated(spark):
    def method_sizes(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", df._jdf.queryExecution().explainString(mode))]

    wide = router.parse_messages(frame(spark, map(json.dumps, MESSAGES)))
    for df in [wide, *(router.table_of(wide, t) for t in [*schemas.RAW, router.QUARANTINE])]:
        # the JVM interprets methods beyond 8000 bytes
        assert (sizes := method_sizes(df)) and max(sizes) < 8000
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("not a JSON object") == 1


def test_flat_and_nested_texts_are_told_apart_alike(spark):
    order = '{"type": "order", "order_id": "%s"%s}'
    good = [order % ("a", ""), order % ("a}b", ""), order % ("a", ', "x": {"y": [1]}'), order % ("a", ', "x": [{}]'), order % ("é😀", "")]
    bad = [t + tail for t in good for tail in ("}", "]", "{}", ' "}', "x")] + [order % ("a", f', "x": {n}') for n in ("NaN", "-Infinity", "01")]
    tables = router.route(frame(spark, [*good, *bad]))
    assert tables["orders"].count() == len(good)
    assert sorted(r.value for r in tables["quarantine"].collect()) == sorted(bad)
    assert {r.reason for r in tables["quarantine"].collect()} == {"not a JSON object"}


def test_one_table_alone_has_the_rows_it_has_among_all(spark, rows):
    """Types may be escaped, keys may come twice, texts may be broken or hold no known field."""
    odd = ['{"type": "or\\u0064er", "order_id": "o9", "user_id": 3}', '{"type": "view", "search_text": "order"}',
           '{"type": "order", "order_id": "o8", "order_id": null, "total_usd": 1e400}', '{"type": "event", "type": "order"}',
           "{}", '{"other": 1}', '{"other": "a\nb"}', '{"other": 1', "{'type': 'order', 'user_id': '5'}", '{"lat": NaN}',
           '{"order_status": 1, "type": "order_status", "order_id": "a", "status": "success"} x', "﻿{}"]
    given = frame(spark, [*map(json.dumps, MESSAGES), *BAD, *odd, None])
    wide = router.parse_messages(given)
    for table in [*schemas.RAW, router.QUARANTINE]:
        alone = router.table_of(router.parse_messages(given, only=table), table)
        assert rows(alone) == rows(router.table_of(wide, table)), table
    reasons = {r.value: r.reason for r in router.table_of(wide, router.QUARANTINE).collect()}
    assert reasons["{}"] == reasons['{"other": 1}'] == "timestamp: missing"
    for text in ('{"other": "a\nb"}', '{"other": 1', '{"lat": NaN}', "﻿{}", None):
        assert reasons[text] == "not a JSON object", text


def test_messages_of_other_tables_are_not_parsed(spark):
    """A cheap filter lies below the parser, which reads the table's own fields only."""
    plan = router.table_of(router.parse_messages(frame(spark, ["{}"]), only="orders"), "orders")
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("order_ts,StringType") < plan.rindex("Contains(value#")
    assert "StructField(birth_date" not in plan and "StructField(order_ts,StringType,true), StructField(_corrupt" not in plan


def test_landing_keeps_a_file_per_route_open(spark, tmp_path):
    """With as many writers as routes, a task need not sort its rows."""
    ingest.append_raw(str(tmp_path / "raw"))(frame(spark, map(json.dumps, MESSAGES)), 0)
    try:
        assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) == len(schemas.RAW) + 1
        assert ingest.read_landed(spark, str(tmp_path / "raw")).count() == len(MESSAGES)
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")


def test_a_message_is_read_with_the_fields_of_its_own_table(spark):
    """The table is guessed from the text; the type that was read decides."""
    order = {"type": "order", "order_id": "a", "user_id": 1, "order_ts": "2024-01-02T03:04:05", "total_usd": 2}
    misleading = [{**order, "user_id": "order_item"}, {**EVENT, "user_id": "order_status"}, {**order, "x": {"type": "user_device"}},
                  {"type": "order_item", "order_id": "order_status", "product_id": 4}, {"order_id": "user_profile", **EVENT}]
    texts = [*map(json.dumps, misleading), "{'type': 'order_item', 'order_id': 'a', 'product_id': '4'}",
             '{"type": "order_item", "order_id": "a", "product_id": 4, "type": "order"}']
    wide = router.parse_messages(frame(spark, texts))
    assert {r.table_name: r.n_rows for r in router.route_counts(wide).collect()} == {"events": 2, "orders": 3, "order_items": 2}
    assert sorted(r.user_id or "" for r in router.table_of(wide, "orders").collect()) == ["", "1", "order_item"]
    assert [r.product_id for r in router.table_of(wide, "order_items").collect()] == [4, 4]
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    item = ["type", *(f.name for f in router.message_fields("order_items"))]
    assert "from_json(" + ", ".join(f"StructField({name},StringType,true)" for name in item) + ", (" in plan


def test_texts_that_only_begin_like_a_type_are_not_parsed_for_it(spark):
    """Every message of an item names "order" in its fields; only a closed string can be the type."""
    plan = router.table_of(router.parse_messages(frame(spark, ["{}"]), only="orders"), "orders")
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert ', order")' in plan and ", order')" in plan and ", order)" not in plan
