import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from mosaiq.functions import text as T

NAMES = [
    ("Warner Silver Blueport Inc", "warner silver blueport incorporated", "warnersilverblueport", "wsblueport"),
    ("https://www.Foo.co.in", "foo", "foo", ""),
    ("A & B Trading", "a b trading", "abtrading", "abtrading"),
    ("A&B", "aandb", "aandb", ""),
    ("x S.A.S.U", "x sas u", "xsasu", "xu"),
    ("Acme Pvt. Ltd.", "acme private limited", "acme", ""),
    ("Visa", "visa", "vi", ""),
    ("Kansas", "kansas", "kan", ""),
    ("Primary Care Partners LLC", "primary care partners llc", "primarycarepartners", "pcpartners"),
    ("Tata Consultancy Services", "tata consultancy services", "tataconsultancyservices", "tcservices"),
    ("प्राइवेट लिमिटेड", "private limited", "", ""),
    (None, "", "", ""),
    ("", "", "", ""),
]
ADDRESSES = [
    ("5 bis Rue Pierre Dignac, La Teste-de-Buch, 33260", ("5 bis", "rue pierre dignac", "la teste de buch", "33260")),
    ("105 ELM ST, MORGANTON, NC 28655", ("105", "elm street", "morganton nc", "28655")),
    ("KH NO. -570/13, NEW DELHI, WEST DELHI, Delhi 110041", ("kh no 570 13", "", "new delhi west delhi delhi", "110041")),
    ("3033 Robin Hill Lane, Garland, TX", ("3033", "robin hill lane", "garland tx", "")),
    ("Robin Hill Lane, Garland, Texas", ("", "robin hill lane", "garland texas", "")),
    ("G-3/571, GULMOHAR COLONY, BHOPAL, Madhya Pradesh", ("g 3 571", "", "gulmohar colony bhopal madhya pradesh", "")),
    ("105th Street, X", ("", "105th street", "x", "")),
    (None, ("", "", "", "")),
    ("   ", ("", "", "", "")),
]


def test_names(spark):
    df = spark.createDataFrame([(n,) for n, *_ in NAMES], "s string").withColumn("n", T.normalize_text(F.col("s")))
    got = df.select("n", T.compact_signature(F.col("n")).alias("c"), T.acronym(F.col("n")).alias("a")).collect()
    assert [tuple(r) for r in got] == [tuple(x) for _, *x in NAMES]


def test_addresses(spark):
    df = spark.createDataFrame([(a,) for a, _ in ADDRESSES], "s string").select(T.decompose_address(F.col("s")).alias("x")).select("x.*")
    assert [(r.street_num, r.street_name, r.city_state, r.postal) for r in df.collect()] == [x for _, x in ADDRESSES]
    assert df.collect()[1].clean_addr == "105 elm street morganton nc 28655"


@pytest.mark.parametrize("text", ["Éàçß œ ½ ﬁ Ａ ²", "Đặng ł ø æ", "plain", "𝐀𝐁 – …", "한글 é"])
def test_fold_is_the_standard_decomposition(spark, text):
    got = spark.createDataFrame([(text,)], "s string").select(T.fold(F.col("s"))).first()[0]
    assert got == unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()


def test_digits_and_postal_of_any_script(spark):
    row = spark.createDataFrame([("नं १२३ b 45, ४५६७८९",)], "s string").select(T.digits(F.col("s")), T.postal_code(F.col("s"))).first()
    assert row[0] == "१२३45४५६७८९" and row[1] == "४५६७८९"


def test_id_lists(spark):
    df = spark.createDataFrame([(" S2-1, ,S3-2,",), ("",), (None,), ("nan",)], "s string").select(T.id_list(F.col("s")).alias("x"))
    assert [r.x for r in df.collect()] == [["S2-1", "S3-2"], [], [], []]


def test_forms_and_blanks_are_as_by_the_plain_patterns(spark):
    def plain(text, table):
        for to, forms in table:
            text = re.sub(T.forms_pattern(forms), to, text, flags=re.A)
        return text

    texts = ["ltd&co. inc.x corp.", "s.a.s.a.r.l", "sas s.a.s.u, sasu", "a&b s.a&c", "ste soc etablissement ets", "st. rue r. ave.bd cedex all", "no form", "x\x1c\n_ y\t\tz .", " pv.t lt.d l.l.c "]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select("s", *[T._replace_forms(F.col("s"), x).alias(n) for n, x in (("l", T.LEGAL_FORMS), ("a", T.ADDRESS_FORMS))], T.tidy(F.col("s")).alias("t")).collect()
    assert [(r.l, r.a) for r in got] == [(plain(r.s, T.LEGAL_FORMS), plain(r.s, T.ADDRESS_FORMS)) for r in got]
    assert [r.t for r in got] == [re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", r.s, flags=re.A), flags=re.A).strip(" ") for r in got]


def test_normalising_looks_at_no_letter_by_a_class_of_thousands(spark):
    plan = spark.range(1).select(T.normalize_text(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert all(len(p) < 2000 for p in re.findall(r"RLIKE\(?[^)]*", plan, re.I))


def test_ends_are_stripped_as_by_tries_at_every_letter(spark):
    """What is tried only where the ends allow it, or where a sign may become several letters, is what plain patterns give."""
    many = T._folds()[2]
    assert all(re.match(T.SEVERAL.replace(r"\x{BB}", "\xbb").replace(r"\x{BF}", "\xbf").replace(r"\x{131}", "ı"), sign) for sign in many)
    ends = ["", " ", "/", "\n", " ", " ", "\x85", "\r\n", "/ \n", " / ", "http://", "HTTPS://www.", "wWw.", "h", ".com", ".com/", ".in \n", "ſ", "½", "ĳ", "é"]
    texts = [a + b + c for a in ends for b in ("", "x", "a.com b", "é / ñ") for c in ends] + [None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace(F.regexp_replace("t", r"(?U)^\s+|\s+$", ""), "(?i)" + T.URL_PREFIX, "")
    plain = F.regexp_replace(F.regexp_replace(plain, "(?iU)" + T.DOMAIN_ENDING, ""), r"^[ /]+|[ /]+$", "")
    one, to, _ = T._folds()
    table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    signs = F.array_join(F.transform(F.split("t", ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    folded = F.lower(F.regexp_replace(F.translate(signs, one, to), r"[^\x00-\x7F]", ""))
    rows = df.select("t", T.strip_url(F.col("t")).alias("got"), plain.alias("plain"), T.fold(F.col("t")).alias("fold"), folded.alias("folded")).collect()
    assert [(r.t, r.got, r.fold) for r in rows] == [(r.t, r.plain, r.folded) for r in rows] and len(rows) > 1000
    plan = df.select(T.strip_url(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" in plan
