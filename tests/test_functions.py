import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from logweir.functions.codes import PRODUCTS, cyclic, error_headers, error_text, header_text, order_status, user_of_order
from logweir.functions.envelope import build_envelope, decode_log, parse_checked, parse_envelope, readable, stable_id
from logweir.functions.json_fields import has_fields, is_object, json_int, json_text, missing_fields
from logweir.functions.partitioner import key_partition, murmur2

PLACES = {
    0: ["order-2", "order-42", "30", "customer-19", "order-outbox-1", "saga-42", "temp-1", "replay-1", "replay-2", "21", "foobar"],
    1: ["order-0", "order-1", "10", "20", "order-inbox-1", "bad-1"],
    2: ["order-777", "ok-1", "slow-1", "a-little-bit-long-string"],
}
ANCHORS = {"21": -973932308, "foobar": -790332482, "a-little-bit-long-string": -985981536, "abc": 479470107}


def plain_murmur2(data: bytes) -> int:
    m, h = 0x5BD1E995, (0x9747B28C ^ len(data)) & 0xFFFFFFFF
    whole = len(data) - len(data) % 4
    for i in range(0, whole, 4):
        k = int.from_bytes(data[i : i + 4], "little") * m & 0xFFFFFFFF
        h = (h * m & 0xFFFFFFFF) ^ ((k ^ (k >> 24)) * m & 0xFFFFFFFF)
    if len(data) % 4:
        h = (h ^ int.from_bytes(data[whole:], "little")) * m & 0xFFFFFFFF
    h = (h ^ (h >> 13)) * m & 0xFFFFFFFF
    return h ^ (h >> 15)


def test_key_places(spark):
    keys = [(k, p) for p, ks in PLACES.items() for k in ks]
    df = spark.createDataFrame(keys, "key string, place int")
    assert df.where(key_partition("key", 3) != F.col("place")).count() == 0


def test_murmur2_anchors(spark):
    df = spark.createDataFrame([(k,) for k in ANCHORS], "key string")
    for key, unsigned in df.select("key", murmur2("key")).collect():
        assert (unsigned - 2**32 if unsigned >= 2**31 else unsigned) == ANCHORS[key]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=60), min_size=1, max_size=40))
def test_murmur2_any_text(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    assert [r[0] for r in df.select(murmur2("key")).collect()] == [plain_murmur2(k.encode()) for k in keys]


def test_rows_without_key_are_spread(spark):
    df = spark.range(3000).select(
        key_partition(F.lit(None).cast("string"), 3, F.col("id").cast("string")).alias("p")
    )
    counts = dict(df.groupBy("p").count().collect())
    assert set(counts) == {0, 1, 2} and min(counts.values()) > 800
    assert spark.range(1).select(key_partition(F.lit(None).cast("string"), 3)).first()[0] is None


@pytest.mark.parametrize(
    "text, expected",
    [("12.9", 12), ('"12"', 12), ('"abc"', 0), ("null", 0), ("-3.9", -3), ("99999999999", 0), ("true", 0), ("{}", 0)],
)
def test_int_fields(spark, text, expected):
    df = spark.createDataFrame([(f'{{"amount": {text}}}',)], "doc string")
    assert df.select(json_int("doc", "amount")).first()[0] == expected


def test_missing_fields_take_defaults(spark):
    df = spark.createDataFrame([('{"a": null}',), ("{}",), (None,), ("{bad",)], "doc string")
    assert {tuple(r) for r in df.select(json_int("doc", "a"), json_text("doc", "a", "-")).collect()} == {(0, "-")}


@pytest.mark.parametrize("text", ["", None, "{bad", "[1]", '"txt"', "null", "12", "   "])
def test_not_an_object(spark, text):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(is_object("value")).first()[0] is False
    assert df.select(has_fields("value", ["a"])).first()[0] is False


def test_presence_is_not_null(spark):
    df = spark.createDataFrame([('{"customerId": null, "name": "A"}',), ('{"name": "A"}',)], "doc string")
    got = df.select(has_fields("doc", ["customerId", "name"]), missing_fields("doc", ["customerId", "name"]))
    assert [tuple(r) for r in got.collect()] == [(True, []), (False, ["customerId"])]


def test_envelope_roundtrip_and_field_order(spark):
    value = build_envelope(
        F.lit("e1"), F.lit("OrderPaid"), F.lit("o1"), F.struct(F.lit(5).alias("amount")), F.lit("2024-01-01").cast("timestamp")
    )
    df = spark.range(1).select(value.alias("value"))
    text = df.first()[0]
    names = ["eventId", "eventType", "eventVersion", "occurredAt", "producer", "correlationId", "aggregateId", "payload"]
    assert [text.index(f'"{n}"') for n in names] == sorted(text.index(f'"{n}"') for n in names)
    e = df.select(parse_envelope("value").alias("e")).select("e.*").first()
    assert (e.eventId, e.eventType, e.eventVersion, e.aggregateId, e.payload) == ("e1", "OrderPaid", "1", "o1", '{"amount":5}')
    row = decode_log(df).first()
    assert (row.event_id, row.event_version, str(row.occurred_at)) == ("e1", 1, "2024-01-01 00:00:00")


def test_decode_drops_only_non_objects_and_fills_missing(spark):
    df = spark.createDataFrame([("a", "{}"), ("b", "[1]"), ("c", '{"eventType":"X","extra":{"y":1}}')], "key string, value string")
    assert rows(decode_log(df), "key", "event_type", "event_version") == [("a", "", 0), ("c", "X", 0)]


def test_stable_ids_repeat(spark):
    df = spark.range(1).select(stable_id(F.lit("a"), F.lit(1)).alias("x"), stable_id(F.lit("a"), F.lit("1")).alias("y"))
    x, y = df.first()
    assert x == y and len(x) == 64


def test_status_map(spark):
    df = spark.createDataFrame([(t,) for t in ("OrderCreated", "OrderPaid", "OrderConfirmed", "OrderPacked")], "t string")
    assert [r[0] for r in df.select(order_status("t")).collect()] == ["CREATED", "PAID", "CONFIRMED", "OrderPacked"]


def test_users_and_products_of_twelve_orders(spark):
    got = spark.range(1, 13).select("id", user_of_order("id").alias("u"), cyclic(PRODUCTS, "id").alias("p")).collect()
    assert [r.u for r in got[:3]] == [10, 20, 30]
    assert sorted(r.u for r in got) == [10] * 4 + [20] * 4 + [30] * 4
    assert [r.p for r in got] == PRODUCTS and spark.range(13, 14).select(cyclic(PRODUCTS, "id")).first()[0] == "Keyboard"


def test_header_is_read_back(spark):
    df = spark.range(1).select(error_headers(error_text(F.lit("pöison"), 1)).alias("headers"))
    assert df.select(header_text("headers")).first()[0] == "case=pöison; attempt=1"
    assert df.select(header_text("headers", "other")).first()[0] is None


VALUES = [
    "{}", '{"eventId":"e1"}', '{"eventId":"e1","eventType":"X", bad', '{"eventId":"e1"', '{"eventId":"e1"} more',
    '[{"eventId":"e1"}]', "[1]", '"txt"', "null", "", "  ", None, "{bad", "12", '{"eventId":"e1","eventVersion":"x"}',
    '{"eventId":"e1","payload":[1]}', '{"eventId":"e1","payload":{"a":}}', '{"eventId":"e1","payload":{"a":1}',
    '{"eventId":"e1","other":[1,2,}', '{"eventId":null,"eventType":"X"}', '{"eventId":"e1",}',
]


@pytest.mark.parametrize("fields", [None, ["amount"]])
def test_one_pass_check_agrees_with_the_object_test(spark, fields):
    df = spark.createDataFrame([(v,) for v in VALUES], "value string").withColumn("e", parse_checked("value", fields))
    assert df.where(readable("e", "value") != is_object("value")).count() == 0
    assert decode_log(df.select("value"), fields).count() == df.where(is_object("value")).count()


def test_other_parts_give_other_ids(spark):
    parts = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a#b", "", ""), ("a", "#b", ""), ("a", "b", ""), ("1:a", "", "b"), ("-", None, "b")]
    rows = spark.createDataFrame(parts, "x string, y string, z string")
    assert rows.select(stable_id("x", "y", "z").alias("id")).distinct().count() == len(parts)
    assert rows.where("x = 'a'").select(stable_id(F.lit("a"), F.lit("b")).alias("id")).distinct().collect() != (
        rows.where("x = 'a#b'").select(stable_id("x").alias("id")).distinct().collect()
    )
