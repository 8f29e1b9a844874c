"""Normalisation of names and addresses as column expressions: nothing here leaves the JVM."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each legal form is written as, in the order in which they are replaced.
LEGAL_FORMS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("private", ("pvt", "pv.t", "private")),
    ("limited", ("ltd", "lt.d", "limited")),
    ("corporation", ("corp", "corp.", "corporation")),
    ("incorporated", ("inc", "inc.", "incorporated")),
    ("llc", ("llc", "l.l.c")),
    ("and", ("&",)),
    ("sarl", ("sarl", "s.a.r.l")),
    ("sas", ("sas", "s.a.s", "sasu", "s.a.s.u")),
    ("sa", ("sa", "s.a")),
    ("eurl", ("eurl", "e.u.r.l")),
    ("sci", ("sci", "s.c.i")),
    ("snc", ("snc", "s.n.c")),
    ("societe", ("ste", "soc", "societe")),
    ("etablissements", ("ets", "etablissement", "etablissements")),
)
# The same for the parts of addresses.
ADDRESS_FORMS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("street", ("st", "st.", "str")),
    ("road", ("rd", "rd.")),
    ("avenue", ("ave", "ave.", "av", "av.")),
    ("boulevard", ("blvd", "blvd.", "bd", "bd.", "bvd", "bvd.")),
    ("drive", ("dr", "dr.")),
    ("lane", ("ln", "ln.")),
    ("apartment", ("apt", "apt.")),
    ("suite", ("ste", "ste.")),
    ("rue", ("r", "rue")),
    ("chemin", ("chem", "chemin")),
    ("impasse", ("imp", "impasse")),
    ("allee", ("all", "allee")),
    ("place", ("pl", "place")),
    ("route", ("rte", "route")),
    ("", ("cedex",)),
)
# Endings that a signature drops, the first that fits, and words that an acronym leaves out.
SIGNATURE_ENDINGS = ("private limited", "private", "limited", "corporation", "incorporated", "llc", "sarl", "sas", "sa", "eurl", "societe", "etablissements")
ACRONYM_STOPS = ("private", "limited", "corporation", "incorporated", "llc", "sarl", "sas", "sa", "and")
# How transliterated legal and trade words sound, and what they stand for.
PHONETIC: tuple[tuple[str, str], ...] = (
    (r"\bpra+[iy]?[vw]?[a-z]*[td]+\b", "private"),
    (r"\blimitt?e?dd?\b", "limited"),
    (r"\b(?:elelpii|ellpii)\b", "llp"),
    (r"\bi[Nn]ttrne?shnl\b", "international"),
    (r"\binphraasttr[a-z]*\b", "infrastructure"),
    (r"\bmaarketti[Nn]g\b", "marketing"),
    (r"\bpro[Nn]?prttiij?\b", "properties"),
    (r"\bknsttraakshn\b", "construction"),
    (r"\b(?:lo?njisttiks|lojisttiks)\b", "logistics"),
    (r"\bso?lyuush[a-z]*\b", "solutions"),
    (r"\bteknol[a-z]*\b", "technology"),
    (r"\benttr?praa?[iy]z[a-z]*\b", "enterprises"),
    (r"\bkaarp[a-z]*\b", "corporation"),
)
DOMAIN_ENDING = r"\.(com|org|net|in|fr|co\.in|co|biz|info)\b"
URL_PREFIX = r"^(https?://)?(www\.)?"
STREET_NUMBER = r"^(#\s*\d+|kh\s+no\.?\s*[-/]?[\w/]+|plot\s+no\.?\s*\w+|flat\s+no\.?\s*\w+|[a-z]-\d+(/\d+)?|\d+([a-z]\b|\s+(bis|ter)\b|\b))"
POSTAL = r"\b\d{5,6}\b"
# Latin letters for the signs of the Indic blocks, which lie 0x80 apart and are laid out alike, from the first on.
INDIC = (
    ["", "N", "N", "H", "", "a", "aa", "i", "ii", "u", "uu", "R", "L", "eN", "e", "e", "ai", "oN", "o", "o", "au"]
    + ["k", "kh", "g", "gh", "ng", "c", "ch", "j", "jh", "ny", "tt", "tth", "dd", "ddh", "nn", "t", "th", "d", "dh", "n", "nnn"]
    + ["p", "ph", "b", "bh", "m", "y", "r", "rr", "l", "l", "lll", "v", "sh", "ss", "s", "h", "", "", "", "'"]
    + ["aa", "i", "ii", "u", "uu", "R", "RR", "eN", "e", "e", "ai", "oN", "o", "o", "au", "", "", ""]
    + ["AUM", "'", "'", "`", "'", "", "", "", "q", "khh", "ghh", "z", "dddh", "rh", "f", "yy", "RR", "LL", "L", "LL", " / ", " // "]
    + ["0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "."]
)


#: What every sign that becomes several letters matches, and few others that are common.
SEVERAL = r"[^\x00-\x{BB}\x{BF}-\x{131}]"


@functools.cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """From Unicode's own decompositions: signs that become one ASCII letter, those letters, and signs that become several."""
    one, to, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        sign = chr(code)
        if 0xD800 <= code <= 0xDFFF or not (plain := unicodedata.normalize("NFKD", sign).encode("ascii", "ignore").decode()):
            continue
        if len(plain) == 1:
            one.append(sign)
            to.append(plain)
        else:
            many[sign] = plain
    return "".join(one), "".join(to), many


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is worked out once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(text: Column) -> Column:
    """Compatibility decomposition down to ASCII, in lower case; what does not decompose to ASCII is dropped."""
    one, to, many = _folds()
    table = F.create_map(*[F.lit(x) for pair in many.items() for x in pair])
    signs = lambda t: F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(table, c), c)), "")
    # Looked up in translate's map: a class of as many signs is tried sign by sign at every letter.
    spread = lambda t: F.when(t.rlike(SEVERAL) & (F.translate(t, "".join(many), "") != t), signs(t)).otherwise(t)
    plain = lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(spread(t), one, to), r"[^\x00-\x7F]", "")).otherwise(t)
    return F.lower(let(text, plain))


def transliterate(text: Column) -> Column:
    """Signs of the Indic blocks by Latin letters; other signs stay."""
    table = F.array(*[F.lit(x) for x in INDIC + [""] * (0x80 - len(INDIC))])
    place = lambda c: F.pmod(F.ascii(c) - 0x900, F.lit(0x80)) + 1
    signs = F.transform(F.split(text, ""), lambda c: F.when((F.ascii(c) >= 0x900) & (F.ascii(c) <= 0xD7F), F.element_at(table, place(c))).otherwise(c))
    return F.array_join(signs, "")


def forms_pattern(forms: tuple[str, ...]) -> str:
    return r"\b(" + "|".join(re.escape(f) for f in forms) + r")\b"


def _folded_pattern(forms: tuple[str, ...]) -> str:
    """forms_pattern for text in lower case, tried only at letters that a form begins with."""
    return "(?=[" + "".join(sorted({re.escape(f[0]) for f in forms})) + "])" + forms_pattern(forms)


def _replace_forms(text: Column, table: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """For text that is folded. Texts without any form that is written otherwise pass with one look."""
    table = tuple((plain, tuple(f for f in forms if f != plain)) for plain, forms in table)

    def each(x: Column) -> Column:
        out = x
        for plain, forms in table:
            out = F.regexp_replace(out, _folded_pattern(forms), plain) if forms else out
        return F.when(x.rlike(_folded_pattern(tuple(f for _, forms in table for f in forms))), out).otherwise(x)

    return let(text, each)


def tidy(text: Column) -> Column:
    """Punctuation to blanks, blanks to one, none at the ends. Underscores stay. For text that is folded."""
    return F.trim(F.regexp_replace(text, r"\W+", " "))


def missing(text: Column) -> Column:
    """Null for what counts as no value: null, the empty string, the literal nan."""
    return F.when(F.lower(F.trim(text)).isin("", "nan"), F.lit(None)).otherwise(text)


def strip_url(text: Column) -> Column:
    """Without a leading scheme and www, and without domain endings wherever they stand.

    What can match at the ends only is tried only where the first or last letter allows it: else it is tried at each letter.
    """

    def where(ends: Callable[[Column], Column], replaced: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda t: F.when(ends(t), replaced(t)).otherwise(t)

    first, last = (lambda t: F.substring(t, 1, 1)), (lambda t: F.substring(t, -1, 1))
    blanks = where(lambda t: first(t).rlike(r"(?U)\s") | last(t).rlike(r"(?U)\s"), lambda t: F.regexp_replace(t, r"(?U)^\s+|\s+$", ""))
    prefix = where(lambda t: first(t).rlike("[hHwW]"), lambda t: F.regexp_replace(t, "(?i)" + URL_PREFIX, ""))
    # A last line end may stand behind what goes.
    slashes = where(lambda t: first(t).rlike("[ /]") | last(t).rlike(r"[ /\n\r\x{85}\x{2028}\x{2029}]"), lambda t: F.regexp_replace(t, r"^[ /]+|[ /]+$", ""))
    bare = let(let(text, blanks), prefix)
    return let(F.regexp_replace(bare, "(?iU)" + DOMAIN_ENDING, ""), slashes)


def normalize_text(text: Column) -> Column:
    """The comparable form of a name; an empty string for a null."""

    def latin(bare: Column) -> Column:
        heard = transliterate(bare)
        for pattern, word in PHONETIC:
            heard = F.regexp_replace(heard, "(?i)" + pattern, word)
        return F.when(bare.rlike(r"[\x{900}-\x{D7F}]"), heard).otherwise(bare)

    return tidy(_replace_forms(fold(let(strip_url(F.coalesce(text, F.lit(""))), latin)), LEGAL_FORMS))


def compact_signature(norm: Column) -> Column:
    """Letters and digits of a normalised name without its first fitting legal ending."""

    def bare(x: Column) -> Column:
        out = x
        for ending in reversed(SIGNATURE_ENDINGS):
            out = F.when(x.endswith(ending), F.substring(x, 1, F.length(x) - len(ending))).otherwise(out)
        return out

    return F.regexp_replace(let(norm, bare), "[^a-z0-9]", "")


def acronym(norm: Column) -> Column:
    """First letters of all words but the last, and the last word; empty for fewer than two words. Legal words do not count."""
    words = F.filter(F.split(norm, " "), lambda w: (w != "") & ~w.isin(*ACRONYM_STOPS))
    initials = lambda ws: F.array_join(F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w: F.substring(w, 1, 1)), "")
    return let(words, lambda ws: F.when(F.size(ws) >= 2, F.concat(initials(ws), F.element_at(ws, -1))).otherwise(F.lit("")))


def digits(text: Column) -> Column:
    """All decimal digits of any script, in order."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\D", "")


def postal_code(raw: Column) -> Column:
    """The first run of five or six digits that stands alone, or an empty string."""
    return F.regexp_extract(F.coalesce(raw, F.lit("")), "(?U)" + POSTAL, 0)


def decompose_address(raw: Column) -> Column:
    """A struct of clean_addr, street_num, street_name, city_state and postal, all of them empty for a blank address."""

    def of(x: Column) -> Column:
        return let(F.struct(postal_code(x).alias("postal"), _replace_forms(fold(x), ADDRESS_FORMS).alias("norm")), split)

    def split(x: Column) -> Column:
        parts = F.filter(F.transform(F.split(x["norm"], "[,;]+"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", "")), lambda p: p != "")
        return let(F.struct(x["postal"].alias("postal"), x["norm"].alias("norm"), parts.alias("parts")), number)

    def number(x: Column) -> Column:
        first = F.coalesce(F.get(x["parts"], 0), F.lit(""))
        rest = F.array_join(F.slice(x["parts"], 2, F.greatest(F.size(x["parts"]), F.lit(1))), " ")
        return let(F.struct(x["postal"].alias("postal"), x["norm"].alias("norm"), rest.alias("rest"), first.alias("first"), F.regexp_extract(first, STREET_NUMBER, 0).alias("number"), F.split(first, r"\s+").alias("tokens")), fields)

    def fields(x: Column) -> Column:
        lead = F.get(x["tokens"], 0).rlike(r"^\d+$")
        after = F.regexp_replace(F.substring(x["first"], F.length(x["number"]) + 1, F.length(x["first"])), r"^[ \-#/,]+|[ \-#/,]+$", "")
        street_num = F.when(x["number"] != "", x["number"]).when(lead, F.get(x["tokens"], 0)).otherwise(F.lit(""))
        street_name = F.when(x["number"] != "", after).when(lead, F.array_join(F.slice(x["tokens"], 2, F.size(x["tokens"])), " ")).otherwise(x["first"])
        city = F.when(x["postal"] != "", F.replace(x["rest"], x["postal"], F.lit(""))).otherwise(x["rest"])
        return F.struct(tidy(x["norm"]).alias("clean_addr"), tidy(street_num).alias("street_num"), tidy(street_name).alias("street_name"), tidy(city).alias("city_state"), x["postal"].alias("postal"))

    return let(F.coalesce(raw, F.lit("")), of)


def embedding_text(prefix: str, norm_name: Column, clean_addr: Column) -> Column:
    return F.trim(F.concat(F.lit(prefix), norm_name, F.lit(" "), clean_addr))


def id_list(text: Column) -> Column:
    """The ids of a comma list: trimmed, without empty ones; a null or nan is an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(missing(text), F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def join_ids(ids: Column) -> Column:
    return F.array_join(ids, ",")
