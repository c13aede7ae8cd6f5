import json
import re

from pyspark.sql import functions as F

from letbook.functions.model import first_filled, model_fields, with_model

FULL = {
    "propertyData": {
        "address": {"displayAddress": "1 High St", "outcode": "AB1", "incode": "2CD"},
        "bedrooms": 3,
        "propertySubType": "Flat",
        "propertyType": "Other",
        "sizings": [{"display": ""}, {"display": "80 sq m"}, {"display": "900 sq ft"}],
    },
    "analyticsInfo": {"analyticsProperty": {"postcode": "AB1 2CD", "price": 250000}},
}


def page(body, tail=";</script>"):
    return f"<html><script>var a = {{}};</script><script>window.PAGE_MODEL = {body}{tail}<p>{{x}}</p></html>"


def leaves(model):
    """What the fields of a model have to be, straight from the parsed object."""
    data = model.get("propertyData") or {}
    tracked = (model.get("analyticsInfo") or {}).get("analyticsProperty") or {}
    addr = data.get("address") or {}
    price, beds = tracked.get("price"), data.get("bedrooms")
    joined = " ".join(x for x in (addr.get("outcode"), addr.get("incode")) if x is not None).strip()
    number = None
    if beds is not None and re.fullmatch(r"-?\d+(\.\d+)?", str(beds)):
        number = int(float(beds))
    return (
        addr.get("displayAddress") or None,
        tracked.get("postcode") or joined or None,
        int(price) if price is not None and str(price).isdigit() else None,
        number,
        data.get("propertySubType") or data.get("propertyType") or None,
        next((s["display"] for s in data.get("sizings") or [] if s.get("display")), None),
    )


def read(spark, pages, form="braces", **options):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    out = with_model(rows, form).select("i", *model_fields(F.col("model"), **options)).orderBy("i").collect()
    return [tuple(r)[1:] for r in out]


def changed(path, *value):
    """The full model with one place set to a value, or taken out."""
    model = json.loads(json.dumps(FULL))
    *way, last = path.split(".")
    at = model
    for step in way:
        at = at[step]
    if value:
        at[last] = value[0]
    else:
        del at[last]
    return model


MODELS = [
    FULL,
    {},
    {"propertyData": {}},
    {"propertyData": None, "analyticsInfo": {"analyticsProperty": None}},
    *[changed("analyticsInfo.analyticsProperty.price", v) for v in ("250000", 250000.0, -1, "", None, "1,000", True)],
    changed("analyticsInfo.analyticsProperty.price"),
    *[changed("propertyData.bedrooms", v) for v in ("3", 3.0, "studio", None, 2.9)],
    *[changed("analyticsInfo.analyticsProperty.postcode", v) for v in ("", None)],
    changed("analyticsInfo.analyticsProperty.postcode"),
    *[changed("propertyData.sizings", v) for v in (None, [], [{}], [{"display": None}, {"display": "x"}])],
    changed("propertyData.sizings"),
    *[changed("propertyData.propertySubType", v) for v in ("", None)],
    changed("propertyData.address"),
    changed("propertyData.address.displayAddress", ""),
    changed("propertyData.address.displayAddress", 'Quote " and \\ and é £ {brace} };'),
    dict(FULL, extra={"deep": [1, {"x": [{}]}]}),
]


def test_fields_of_every_model(spark):
    pages = [page(json.dumps(m)) for m in MODELS]
    assert read(spark, pages) == [leaves(m) for m in MODELS]
    assert read(spark, pages, "pattern") == [leaves(m) for m in MODELS]


def test_postcode_parts(spark):
    parts = [("AB1", "2CD"), ("AB1", None), (None, "2CD"), (None, None), ("", "")]
    models = []
    for outcode, incode in parts:
        model = changed("analyticsInfo.analyticsProperty.postcode", "")
        model["propertyData"]["address"].update(outcode=outcode, incode=incode)
        models.append(model)
    got = [r[1] for r in read(spark, [page(json.dumps(m)) for m in models])]
    assert got == ["AB1 2CD", "AB1", "2CD", None, None]


NOTHING = (None,) * 6


def test_pages_without_a_good_model(spark):
    good = json.dumps(FULL)
    pages = {
        "no script": "<html></html>",
        "no brace": "window.PAGE_MODEL = null",
        "cut off": page(good[:-30]),
        "single quotes": page("{'propertyData': {}}"),
        "array": page("[1]"),
        "empty": "",
        "null": None,
    }
    assert read(spark, list(pages.values())) == [NOTHING] * len(pages)
    assert read(spark, list(pages.values()), "pattern") == [NOTHING] * len(pages)


def test_line_breaks_inside_a_text(spark):
    broken = json.dumps(FULL).replace("1 High St", "1 High\r\n St")
    assert read(spark, [page(broken)])[0] == leaves(FULL)
    assert read(spark, [page(broken)], "pattern")[0] == NOTHING


def test_braces_inside_a_text_do_not_end_the_model(spark):
    """Counting braces would lose this row; reading the JSON keeps it."""
    model = changed("propertyData.address.displayAddress", "Flat } 1")
    assert read(spark, [page(json.dumps(model))])[0] == leaves(model)


def test_text_after_the_object(spark):
    body = json.dumps(FULL) + "; window.more = {}"
    assert read(spark, [page(body)])[0] == leaves(FULL)
    assert read(spark, [page(body)], "pattern")[0] == NOTHING


def test_spacing_and_second_marker(spark):
    good = json.dumps(FULL, indent=2)
    assert read(spark, [page(good).replace(" = ", "   =\n  ")])[0] == leaves(FULL)
    assert read(spark, [page(good).replace(" = ", "="), page(good) + page("{}")], "pattern") == [leaves(FULL)] * 2


def test_any_price(spark):
    models = [changed("analyticsInfo.analyticsProperty.price", v) for v in (250000.0, -1, "12", "x")]
    got = [r[2] for r in read(spark, [page(json.dumps(m)) for m in models], strict_price=False)]
    assert got == [250000, -1, 12, None]


def test_first_filled(spark):
    rows = spark.createDataFrame(
        [([("",), (None,), ("b",)],), ([],), (None,), ([("",)],)], "a array<struct<display: string>>"
    )
    out = rows.select(first_filled(F.col("a"), "display").alias("r")).collect()
    assert [r.r for r in out] == ["b", None, None, None]
