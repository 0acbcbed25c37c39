from __future__ import annotations

import pytest
from conftest import rows

from affinia.operators.ids import decode_ids, decode_recs, encode_ids, id_dictionary


@pytest.fixture
def text(spark):
    data = [(f"u{(7 * i) % 23:02d}", f"i{(5 * i) % 41:02d}", float(i)) for i in range(200)]
    return spark.createDataFrame(data, "user string, item string, pref double").repartition(5)


def test_dictionary_is_dense_and_in_key_order(text):
    ids = sorted({r.item for r in text.collect()})
    assert rows(id_dictionary(text, "item"), "id", "idx") == [(v, n + 1) for n, v in enumerate(ids)]


def test_dictionary_of_nothing(text):
    assert id_dictionary(text.where("pref < 0"), "item").count() == 0


def test_round_trip(text):
    users, items = id_dictionary(text, "user"), id_dictionary(text, "item")
    encoded = encode_ids(encode_ids(text, users, "user"), items, "item")
    assert encoded.columns == text.columns
    assert dict(encoded.dtypes)["user"] == "bigint"
    columns = ("user", "item", "pref")
    assert rows(decode_recs(encoded, users, items), *columns) == rows(text, *columns)
    assert rows(decode_recs(encoded, items=items), "item") == rows(text, "item")


def test_unknown_ids_stay_as_blanks(spark, text):
    items = id_dictionary(text, "item")
    odd = spark.createDataFrame([("u00", "nowhere", 1.0)], text.schema)
    assert encode_ids(odd, items, "item").first().item is None
    assert decode_ids(spark.createDataFrame([(9999,)], "item bigint"), items, "item").first().item is None
