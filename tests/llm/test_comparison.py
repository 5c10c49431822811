"""The comparison SQL and the operators agree on awkward rows, which the given tables hold few of."""

import duckdb
import pytest
from pyspark.sql import functions as F

from martloom.llm import queries

TEXTS = [
    "DE89370400440532013000,GB82 WEST 1234 5698 7654 32 GB82WEST12345698765432",
    "iban: DE89370400440532013001 x DE89 3704 0044 0532 0130 00;DE89370400440532013000\nDE89370400440532013000",
    "ssn 123-45-6789,123-45-6789 social 987-65-4321-1 999-99-9999 security: 111-22-3333",
    "call +1 (555) 123-4567 or +1 23 and +49 30 1234567890123456 \U0001f600 +4930123456",
    "visa 4111 1111 1111 1111 4111111111111112 4012-8888-8888-1881 5 4 3",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 " + "9" * 60 + ".1.1.1 server 10.0.0.1",
    "a@b a@b.c mail a.b+c@d-e.f.g..h @x.y a@b.c@d.e Contact: ünï@code.org",
    "\U0001f600 é " * 30 + "x@y.zz",
    "12345 " * 2000 + "x@y.zz",
]
# account numbers before other words and after each other, inside failed ones, with and without context, of unknown countries
NUMBERS = ["BE71 0961 2345 6769", "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00"]
WORDS = ["BIC", "EUR 20", "2024", "BIC GEBABEBB", "XX", "EUROPE 2024 1234 5678 9012", "today", "\nBIC", "é"]
TEXTS += [f"{a}{n} {w}" for n in NUMBERS for w in WORDS for a in ("", "Konto ")]
TEXTS += [n.replace(" ", "") + f" {w}" for n in NUMBERS for w in WORDS]
TEXTS += [
    " ".join(NUMBERS), ", bank ".join(NUMBERS), "iban BE12 AT61 1904 3002 3457 3201", "BE71 0961 2345 6768 BIC",
    "xBE71 0961 2345 6769 BIC", "account AB12 CD34 EF56 " + NUMBERS[0], "AB12CD34 BE71096123456769BE71096123456769",
    "ZZ33 1234 5678 9012 345 A ZZ59 1234 5678 9012 3456 77, ZZ591234567890123456", "\U0001f600 iban\t" + NUMBERS[3] + ";" + NUMBERS[3],
]


@pytest.fixture(scope="module")
def tables(spark, odd, tmp_path_factory):
    """A folder whose documents are the awkward rows, with empty and full sources."""
    own = spark.createDataFrame([(100 + k, t, "en", f"s{k % 5}") for k, t in enumerate(TEXTS)],
                                "doc_id long, text string, lang string, source string")
    blank = own.withColumns({"doc_id": F.col("doc_id") + 100, "text": F.lit(" "), "source": F.lit("zero")})
    folder = str(tmp_path_factory.mktemp("odd"))
    rows = odd.select(own.columns).unionByName(own).unionByName(blank)
    rows.write.parquet(f"{folder}/documents.parquet")
    rows.limit(0).write.parquet(f"{folder}/none/documents.parquet")
    return folder


@pytest.mark.parametrize("name", ["op2_curriculum_mix", "op9_personal_data"])
@pytest.mark.parametrize("part", ["", "/none"])
def test_operator_equals_its_sql(spark, tables, name, part):
    got = queries.QUERIES[name](spark, tables + part)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}{part}/documents.parquet/*.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(columns).collect()) == expected
    assert bool(expected) == (part == "")


def test_every_kind_occurs(spark, tables):
    found = ",".join(r.spans for r in queries.op9_personal_data(spark, tables).select("spans").collect())
    assert {s.split(":")[0] for s in found.split(",") if s} == {"email", "ip", "card", "phone", "iban", "ssn"}
