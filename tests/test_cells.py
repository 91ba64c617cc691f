"""Cell rules on the hand-made file (FIXTURES.md §2)."""

import bz2
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from fieldnotes.functions.cells import binary_label
from fieldnotes.operators.parse import (bad_cell_counts, category_codes, category_values,
                                        encode_categories, long_form, parse)
from fieldnotes.sources.csv import read_observations
from fieldnotes.spec import FeatureSpec

HAND = """ID,A,B,KIND,L
S101,1.5,0,red,3
S102,?,2,blue,0
S103,X,4,?,X
S104,0,?,red,?
S105,-2,1e2,green,1
S106,7
"""

SPEC = FeatureSpec(columns=("ID", "A", "B", "KIND", "L"), label="L", key="ID",
                   id_cols=("ID",), discrete=("KIND",))

EXPECTED = {
    "S101": (101.0, 1.5, 0.0, "red", 3.0),
    "S102": (102.0, None, 2.0, "blue", 0.0),
    "S103": (103.0, 0.0, 4.0, None, 0.0),
    "S104": (104.0, 0.0, None, "red", None),
    "S105": (105.0, -2.0, 100.0, "green", 1.0),
    "S106": (106.0, 7.0, 0.0, None, 0.0),
}


def write(tmp, name, text, compress=False):
    path = os.path.join(tmp, name)
    if compress:
        with bz2.open(path, "wt") as fh:
            fh.write(text)
    else:
        with open(path, "w") as fh:
            fh.write(text)
    return path


def rows(df):
    return {r["ID"]: (r["ID_num"], r["A"], r["B"], r["KIND"], r["L"]) for r in df.collect()}


def test_hand_file(spark, tmp):
    path = write(tmp, "hand.csv", HAND)
    wide = parse(read_observations(spark, path, SPEC), SPEC)
    assert wide.columns == ["ID", "ID_num", "A", "B", "KIND", "L"]
    assert rows(wide) == EXPECTED


def test_two_files_and_bz2(spark, tmp):
    head, *body = HAND.splitlines(keepends=True)
    d = os.path.join(tmp, "parts")
    os.makedirs(d)
    write(d, "a.csv", head + "".join(body[:3]))
    write(d, "b.csv", head + "".join(body[3:]))
    assert rows(parse(read_observations(spark, d, SPEC), SPEC)) == EXPECTED
    z = write(tmp, "hand.csv.bz2", HAND, compress=True)
    assert rows(parse(read_observations(spark, z, SPEC), SPEC)) == EXPECTED


def test_binary_label_drops_missing(spark, tmp):
    wide = parse(read_observations(spark, write(tmp, "h.csv", HAND), SPEC), SPEC)
    got = {r["ID"]: r["y"] for r in wide.select("ID", binary_label("L").alias("y")).collect()}
    assert got == {"S101": 1.0, "S102": 0.0, "S103": 0.0, "S104": None, "S105": 1.0,
                   "S106": 0.0}


def test_long_form_keeps_nonzero_and_missing(spark, tmp):
    wide = parse(read_observations(spark, write(tmp, "h.csv", HAND), SPEC), SPEC)
    long = {(r["ID"], r["feature"]): r["value"] for r in long_form(wide, SPEC, "ID").collect()}
    assert long[("S102", "A")] is None
    assert ("S101", "B") not in long          # zero not stored
    assert long[("S105", "B")] == 100.0
    # 6 rows x 3 numeric features = 18 cells, minus 7 zeros
    assert len(long) == 11


@pytest.mark.parametrize("bad_line, kind", [
    ("SX,1,2,red,1", "id"),
    ("S107,abc,2,red,1", "numeric"),
])
def test_bad_cells_raise_or_count(spark, tmp, bad_line, kind):
    path = write(tmp, f"bad_{kind}.csv", HAND + bad_line + "\n")
    with pytest.raises(Exception, match=f"bad {kind} cell"):
        parse(read_observations(spark, path, SPEC), SPEC).collect()
    counts = bad_cell_counts(read_observations(spark, path, SPEC), SPEC).first().asDict()
    assert sum(counts.values()) == 1


def test_empty_cell_zero_or_strict(spark, tmp):
    path = write(tmp, "empty.csv", "ID,A,B,KIND,L\nS1,,2,red,1\n")
    wide = parse(read_observations(spark, path, SPEC, keep_empty=True), SPEC)
    assert wide.first()["A"] == 0.0
    strict = parse(read_observations(spark, path, SPEC, keep_empty=True), SPEC,
                   strict_empty=True)
    with pytest.raises(Exception, match="bad empty cell"):
        strict.collect()


def test_nan_text_is_missing(spark, tmp):
    path = write(tmp, "nan.csv", "ID,A,B,KIND,L\nS1,NaN,2,red,1\n")
    assert parse(read_observations(spark, path, SPEC), SPEC).first()["A"] is None


def test_dictionary_alphabetical_and_lookup(spark, tmp):
    wide = parse(read_observations(spark, write(tmp, "h.csv", HAND), SPEC), SPEC)
    codes = category_codes(category_values(wide, ["KIND"]))
    assert {r["category"]: r["code"] for r in codes.collect()} == {"blue": 0, "green": 1,
                                                                   "red": 2}
    enc = {r["ID"]: r["KIND_code"] for r in encode_categories(wide, codes, ["KIND"]).collect()}
    assert enc == {"S101": 2, "S102": 0, "S103": None, "S104": 2, "S105": 1, "S106": None}


def test_spec_roles():
    assert SPEC.continuous == ("A", "B", "L")
    assert SPEC.predictors == ("A", "B", "KIND")
    with pytest.raises(ValueError):
        FeatureSpec(columns=("a",), label="b")
    assert FeatureSpec.from_json(SPEC.to_json()) == SPEC


def test_sliced_unpivot_equals_single(spark):
    from fieldnotes.operators.parse import unpivot_sliced
    from fieldnotes.plans.fixtures import obs
    from tests.conftest import SF_SMALL
    o = obs(spark, SF_SMALL).withColumnRenamed("f_effort", "f effort")
    feats = ["f_day", "f_hour", "f effort", "label_count"]
    keep = F.col("value").isNull() | (F.col("value") != 0)
    one = unpivot_sliced(o, ["event_id"], feats, "feature", "value", keep, width=100)
    many = unpivot_sliced(o, ["event_id"], feats, "feature", "value", keep, width=1)
    assert many.columns == one.columns
    assert one.count() == many.count() > 0
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
