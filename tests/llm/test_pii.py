import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import corpus
from touchpath.llm import pii
from touchpath.llm.queries import QUERIES

KEY = "k1"


def feistel(v, left, right, tweak):
    a, b = divmod(v, right)
    for r in range(pii.ROUNDS):
        word = lambda half: int(hashlib.sha256(f"{KEY}|{tweak}|{r}|{half}".encode()).hexdigest()[:12], 16)  # noqa: B023, E731
        if r % 2 == 0:
            a = (a + word(b)) % left
        else:
            b = (b + word(a)) % right
    return a * right + b


def luhn_ok(d):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0


def run(spark, *texts):
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return [r for r in sorted(pii.pseudonymise(d, KEY).collect())]


def test_values_keep_their_format_and_stay_linked(spark):
    card, phone, ip = "4417744280351547", "+1 (017) 555-7713", "97.51.17.173"
    assert luhn_ok(card)
    a, b, c = run(spark, f"pay {card}, call {phone} from {ip}.", f"é😀{card[:4]} {card[4:8]} {card[8:12]} {card[12:]}!! {phone}%%%", f"x {ip} 4417744280351548 123-45-6789 1999-12-31 me.55@mail9.example.com")
    new = re.search(r"pay ([0-9]{16}), call (\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}) from ([0-9.]+[0-9])\.$", a["text"])
    assert new and new[1] != card and luhn_ok(new[1]) and new[2] != phone and new[3] != ip
    want = feistel(int(card[:15]), 10**7, 10**8, "card")
    assert new[1][:15] == f"{want:015d}"
    assert re.sub(r"\D", "", new[2])[1:] == f"{feistel(int('0175557713'), 10**5, 10**5, 'phone'):010d}"
    n = new[1]
    assert b["text"] == f"é😀{n[:4]} {n[4:8]} {n[8:12]} {n[12:]}!! {new[2]}%%%"
    assert c["text"].startswith(f"x {new[3]} 4417744280351548 ")
    assert "123-45-6789" not in c["text"] and "1999-12-31" not in c["text"] and "me.55" not in c["text"] and c["text"].endswith("@mail9.example.com")
    assert (a["n_card"], a["n_phone"], a["n_ip"], c["n_card"], c["n_national"], c["n_date"], c["n_mail"]) == (1, 1, 1, 0, 1, 1, 1)


def test_feistel_is_a_permutation_on_small_domains(spark):
    d = spark.range(189 * 773).select(pii.feistel(F.col("id"), F.lit(189).cast("long"), F.lit(773).cast("long"), KEY, "date").alias("v"))
    assert d.agg(F.count_distinct("v"), F.min("v"), F.max("v")).first()[:] == (146097, 0, 146096)
    assert [r["v"] for r in d.limit(20).collect()] == [feistel(i, 189, 773, "date") for i in range(20)]


@pytest.mark.parametrize("shape", ["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y"])
def test_dates_in_all_formats_move_to_the_same_day(spark, shape):
    day = datetime.date(2011, 3, 9)
    (r,) = run(spark, f"on {day.strftime(shape)} it")
    index = (day - datetime.date(1800, 1, 1)).days
    new = datetime.date(1800, 1, 1) + datetime.timedelta(days=feistel(index, 189, 773, "date"))
    assert r["text"] == f"on {new.strftime(shape) if new.year > 999 else new} it"


def test_phones_without_separators_stay_linked(spark):
    new = f"{feistel(5552345678, 10**5, 10**5, 'phone'):010d}"
    forms = ["+15552345678", "5552345678", "15552345678", "+1 5552345678", "+1(555)2345678", "(555)2345678", "+1-555-234-5678", "555.234.5678", "+915552345678"]
    for form, r in zip(forms, run(spark, *[f"call {x}, or" for x in forms])):
        assert re.sub(r"\D", "", r["text"]) == re.sub(r"\D", "", form)[:-10] + new and r["n_phone"] == 1
        assert re.sub("[0-9]", "9", r["text"]) == re.sub("[0-9]", "9", f"call {form}, or")
    texts = ["1700000000 0552345678 5551345678 5952345678", "x5552345678 -5552345678 5552345678.5 55523456789"]
    assert [r["text"] for r in run(spark, *texts)] == texts


def test_timestamps_and_short_dates_move_to_the_same_day(spark):
    day = datetime.date(1980, 3, 4)
    new = datetime.date(1800, 1, 1) + datetime.timedelta(days=feistel((day - datetime.date(1800, 1, 1)).days, 189, 773, "date"))
    wide, (y, m, d) = new.isoformat(), (new.year, new.month, new.day)
    pairs = [("1980-03-04T12:00:00Z", f"{wide}T12:00:00Z"), ("1980-03-04t12:00", f"{wide}t12:00"), ("1980-03-04", wide), ("3/4/1980", f"{m}/{d}/{y}"),
             ("03/4/1980", f"{m}/{d}/{y}"), ("4.3.1980", f"{d}.{m}.{y}"), ("1980-3-4", f"{y}-{m}-{d}"), ("1980/3/4", f"{y}/{m}/{d}")]
    assert [(r["text"], r["n_date"]) for r in run(spark, *[old for old, _ in pairs])] == [(x, 1) for _, x in pairs]
    texts = ["1980-03-04Total 1980-03-04x", "13/32/1980 0.3.1980 1980-13-1"]
    assert [r["text"] for r in run(spark, *texts)] == texts


def test_what_does_not_validate_is_left_alone(spark):
    texts = ["2011-13-09 2011-02-30 99.99.2011", "000-12-3456 666-12-3456 900-12-3456 123-00-4567 123-45-0000", "300.1.1.1 1.2.3 1.2.3.4.5", "1234567890123456 12345", "a@b @x.y v1.2.3.4x", "Version 2.0"]
    assert [r["text"] for r in run(spark, *texts)] == texts


def test_national_numbers_stay_valid_and_distinct(spark):
    texts = [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 99) for s in (1, 9999)]
    new = [r["text"] for r in run(spark, *texts)]
    assert len(set(new)) == len(texts) and all(re.match(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$", t) for t in new)


def test_query_leaves_clean_rows_and_real_text_loses_its_values(spark, table):
    folder = table(corpus())
    out = QUERIES["op5_feistel_pseudonyms"](spark, folder)
    assert sorted((r["doc_id"] or -1, r["text"] or "~") for r in out.collect()) == sorted((i or -1, t or "~") if t else (i or -1, "" or ("~" if t is None else "") or "~") for i, t, *_ in corpus())
    assert QUERIES["op5_feistel_pseudonyms"](spark, table([])).collect() == []
    real = "/root/testdata/sf0.01"
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{real}/documents.parquet").collect()}
    hidden = 0
    for r in QUERIES["op5_feistel_pseudonyms"](spark, real).collect():
        old = before[r["doc_id"]]
        values = [m[0] for m in re.finditer(r"(?<![\w.])\d{16}(?!\w)", old) if luhn_ok(m[0])] + re.findall(r"\+1 \(\d{3}\) \d{3}-\d{4}", old) + re.findall(r"[\w.]+@mail\d", old)
        hidden += len(values)
        assert not any(v in r["text"] for v in values)
        if not any(r[f"n_{k}"] for k in pii.KINDS):
            assert r["text"] == old
    assert hidden > 20


def test_plan_has_no_python_and_clashing_columns_stay(spark, docs):
    d = docs.withColumn("kinds", F.lit(1)).withColumn("n_card", F.lit("x")).withColumn("_new", F.lit(2)).withColumn("new", F.lit(3)).withColumn("row", F.lit(4))
    out = pii.pseudonymise(d, KEY)
    assert out.columns == [*docs.columns, "kinds", "_new", "new", "row", *[f"n_{k}" for k in pii.KINDS]]
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
