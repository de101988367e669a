"""Scalar functions as column expressions. White space, digits and letter case follow Unicode ((?U) in Java patterns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WS = r"[\s\x1c-\x1f]"

# Texts that stand for a missing value (compared in lower case, after trimming).
NULL_TOKENS = ("", "nan", "none", "null", "n/a", "na", "-", "—", "нет данных")

# A normalized name with one of these inside is an organization.
ORG_KEYWORDS = (
    "ОРГАНИЗАЦ", "ДВИЖЕНИ", "ПАРТИ", "ЦЕНТР", "ФОНД", "ОБЪЕДИНЕНИ", "ОБЩИНА",
    "ГРУПП", "АССОЦИАЦ", "СОЮЗ", "ЦЕРКОВ", "РЕЛИГИОЗН", "БРАТСТВО", "ДЖАМААТ",
    "БАТАЛЬОН", "ПОЛК", "КОНГРЕСС", "ФЕДЕРАЦ", "ИМПЕРИ", "СООБЩЕСТВ", "ФРОНТ",
    "АРМИЯ", "СЕТЬ", "МЕДИА", "УЧРЕЖДЕН", "КОМПАНИ", "ОБЩЕСТВО", "ПРОЕКТ",
    "FOUNDATION", "CENTER", "PROJECT", "MEDIA", "NETWORK",
)

# Stems of very common surnames; a person whose name starts with one may be a namesake.
COMMON_SURNAMES = (
    "ИВАНОВ", "СМИРНОВ", "КУЗНЕЦОВ", "ПОПОВ", "ВАСИЛЬЕВ", "ПЕТРОВ", "СОКОЛОВ",
    "МИХАЙЛОВ", "НОВИКОВ", "ФЕДОРОВ", "МОРОЗОВ", "ВОЛКОВ", "АЛЕКСЕЕВ",
    "ЛЕБЕДЕВ", "СЕМЕНОВ", "ЕГОРОВ", "ПАВЛОВ", "КОЗЛОВ", "СТЕПАНОВ", "НИКОЛАЕВ",
    "ОРЛОВ", "АНДРЕЕВ", "МАКАРОВ", "НИКИТИН", "ЗАХАРОВ", "ЗАЙЦЕВ", "СОЛОВЬЕВ",
    "БОРИСОВ", "ЯКОВЛЕВ", "ГРИГОРЬЕВ", "РОМАНОВ", "ВОРОБЬЕВ", "СЕРГЕЕВ",
    "КУЗЬМИН", "ФРОЛОВ", "АЛЕКСАНДРОВ", "ДМИТРИЕВ", "КОРОЛЕВ", "ГУСЕВ",
    "КИСЕЛЕВ", "ИЛЬИН", "МАКСИМОВ", "ПОЛЯКОВ", "СОРОКИН", "ВИНОГРАДОВ",
    "КОВАЛЕВ", "БЕЛОВ", "МЕДВЕДЕВ", "АНТОНОВ", "ТАРАСОВ", "ЖУКОВ", "БАРАНОВ",
    "ФИЛИППОВ", "КОМАРОВ", "ДАВЫДОВ", "БЕЛЯЕВ", "ГЕРАСИМОВ", "БОГДАНОВ",
    "ОСИПОВ", "СИДОРОВ", "МАТВЕЕВ", "ТИТОВ", "МАРКОВ", "МИРОНОВ", "КРЫЛОВ",
    "КУЛИКОВ", "КАРПОВ", "ВЛАСОВ", "МЕЛЬНИКОВ", "ДЕНИСОВ", "ГАВРИЛОВ",
    "ТИХОНОВ", "КАЗАКОВ", "АФАНАСЬЕВ", "ДАНИЛОВ", "ЕФИМОВ", "КИРИЛЛОВ",
)

# Single words that are no pattern of their own.
STOPWORDS = (
    "ОБЪЕДИНЕНИЕ", "ОРГАНИЗАЦИЯ", "ГРУППА", "ЦЕНТР", "ФОНД", "ДВИЖЕНИЕ",
    "СОЮЗ", "АССОЦИАЦИЯ", "ОБЩИНА", "СЕТЬ", "ПРОЕКТ", "АРМИЯ", "СИРЕНА",
    "БРАТСТВО", "СООБЩЕСТВО", "ПАРТИЯ", "КОНГРЕСС", "ФРОНТ", "ИМПЕРИЯ",
    "ПОЛК", "БАТАЛЬОН", "ФЕДЕРАЦИЯ", "ОБЩЕСТВО", "КОМПАНИЯ", "МЕДИА",
    "ЦЕРКОВЬ", "СОВЕТ", "КОМИТЕТ", "ШТАБ", "БЛОК", "ФОРУМ",
)

# Confidence labels and the labels of kinds in exports.
HIGH, MEDIUM, LOW = "высокая", "средняя", "низкая (возможен тёзка)"
KIND_LABELS = {"person": "Физическое лицо", "org": "Организация"}

WORD_CLASS = "0-9A-Za-zА-Яа-яЁё"


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), rf"(?U)^{_WS}+|{_WS}+$", "")


def collapse(c: Column | str) -> Column:
    return F.regexp_replace(_text(c), rf"(?U){_WS}+", " ")


def clean_cell(c: Column | str) -> Column:
    """Trimmed text with single blanks; null for null tokens."""
    cleaned = collapse(strip(c))
    return F.when(~F.lower(cleaned).isin(*NULL_TOKENS), cleaned)


def dedup_key(c: Column | str) -> Column:
    """Upper case, single blanks, trimmed; null is the empty text."""
    return F.coalesce(strip(collapse(F.upper(_text(c)))), F.lit(""))


def filled(c: Column | str) -> Column:
    return _text(c).isNotNull() & (strip(c) != "")


def normalize(c: Column | str) -> Column:
    """Matching form: е for ё, runs of other characters as one blank, upper case, trimmed; null is the empty text."""
    folded = F.replace(F.replace(_text(c), F.lit("Ё"), F.lit("Е")), F.lit("ё"), F.lit("е"))
    return F.coalesce(F.trim(F.upper(F.regexp_replace(folded, f"[^{WORD_CLASS}]+", " "))), F.lit(""))


def classify_kind(norm: Column, original: Column) -> Column:
    marks = original.contains("«") | original.contains('"') | original.contains("(")
    person = norm.rlike(r"^[А-Я]\p{L}*( [А-Я]\p{L}*){1,3}$")
    return F.when(norm.rlike("|".join(ORG_KEYWORDS)) | marks, "org").when(person, "person").otherwise("org")


def assess_confidence(norm: Column, original: Column) -> Column:
    common = norm.rlike(f"^(?:{'|'.join(COMMON_SURNAMES)})")
    distinct = (F.char_length(norm) >= 15) | (F.size(F.split(norm, " ")) >= 3) | original.contains("«")
    person = classify_kind(norm, original) == "person"
    return F.when(person & common, LOW).when(person, MEDIUM).when(distinct, HIGH).otherwise(MEDIUM)


def normalize_id(c: Column | str) -> Column:
    """Digits only; a text without digits as it is."""
    digits = F.regexp_replace(_text(c), r"(?U)\D", "")
    return F.when(digits != "", digits).otherwise(_text(c))


def normalize_phone(c: Column | str) -> Column:
    """+7 and ten digits where the text has those, or eleven with a leading 7 or 8; else as it is."""
    digits = F.regexp_replace(_text(c), r"(?U)\D", "")
    return (
        F.when((F.length(digits) == 11) & F.substring(digits, 1, 1).isin("7", "8"), F.concat(F.lit("+7"), F.substring(digits, 2, 10)))
        .when(F.length(digits) == 10, F.concat(F.lit("+7"), digits))
        .otherwise(_text(c))
    )


def normalize_address(c: Column | str) -> Column:
    """Single blanks, no commas at the ends, and one form of the four abbreviations."""
    out = F.regexp_replace(strip(collapse(c)), "^,+|,+$", "")
    for short in ("г", "ул", "д", "кв"):
        out = F.regexp_replace(out, rf"(?iU)\b{short}\.{_WS}*", f"{short}. ")
    return out


def _date(year: Column, month: Column, day: Column) -> Column:
    return F.date_format(F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-M-d")), "yyyy-MM-dd")


def normalize_date(c: Column | str) -> Column:
    """ISO date. Day first unless the text starts like an ISO date; where that gives no date, month first. English month names and years
    of two digits (those of the 50 years before and after 2025) are known. Partial dates and what isn't a date stay as they are."""
    text = _text(c)
    time = r"(?:[T\s]+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2})?)?\s*$"
    iso, dots, plain = rf"(?U)^\s*(\d{{4}})-(\d{{2}})-(\d{{2}}){time}", rf"(?U)^\s*(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{4}}){time}", rf"(?U)^\s*(\d{{4}})(\d{{2}})(\d{{2}}){time}"
    slashed, short = rf"(?U)^\s*(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}}){time}", rf"(?U)^\s*(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{2}}){time}"
    part = lambda pattern, n: F.regexp_extract(text, pattern, n)
    named = strip(F.regexp_replace(text, r"^(\s*\d{1,2})[-/.]([A-Za-z]{3,9})[-/.](\d{4})", "$1 $2 $3"))
    year = F.concat(F.when(part(short, 3) >= "75", "19").otherwise("20"), part(short, 3))
    tries = [
        F.when(text.rlike(iso), _date(part(iso, 1), part(iso, 2), part(iso, 3))),
        F.when(text.rlike(dots), _date(part(dots, 3), part(dots, 2), part(dots, 1))),
        F.when(text.rlike(dots), _date(part(dots, 3), part(dots, 1), part(dots, 2))),
        F.when(text.rlike(slashed), _date(part(slashed, 1), part(slashed, 3), part(slashed, 2))),
        F.when(text.rlike(slashed), _date(part(slashed, 1), part(slashed, 2), part(slashed, 3))),
        F.when(text.rlike(short), _date(year, part(short, 2), part(short, 1))),
        F.when(text.rlike(short), _date(year, part(short, 1), part(short, 2))),
        F.when(text.rlike(plain), _date(part(plain, 1), part(plain, 3), part(plain, 2))),
        F.when(text.rlike(plain), _date(part(plain, 1), part(plain, 2), part(plain, 3))),
        *(F.date_format(F.try_to_timestamp(named, F.lit(f)), "yyyy-MM-dd") for f in ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")),
    ]
    return F.coalesce(*tries, text)


def extract_context(text: Column, norm: Column, width: int = 80) -> Column:
    """What surrounds the first place where norm's words stand in text, whatever separates them; empty if there is none."""
    gap = f"[^{WORD_CLASS}]+"
    words = F.replace(norm, F.lit(" "), F.lit(gap))
    pattern = F.concat(F.lit(f"(?iu)(?<![{WORD_CLASS}])(?:"), words, F.lit(f")(?![{WORD_CLASS}])"))
    at, hit = F.regexp_instr(text, pattern), F.call_function("regexp_extract", text, pattern, F.lit(0))
    first = F.greatest(F.lit(1), at - width)
    snippet = strip(collapse(F.substring(text, first, at + F.length(hit) + width - first)))
    return F.when((norm != "") & (at > 0), F.concat(F.lit("…"), snippet, F.lit("…"))).otherwise("")


def host_of(url: Column) -> Column:
    """Host with port, in lower case, of a url with a scheme; else empty."""
    return F.lower(F.regexp_extract(url, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def clean_host(c: Column | str) -> Column:
    """The bare host of an entry in a list of hosts: no scheme, path or query, lower case."""
    bare = F.regexp_replace(F.lower(strip(c)), "^https?://", "")
    return F.regexp_extract(bare, r"(?s)^([^/?]*)", 1)


def in_scope(host: Column, suffix: str) -> Column:
    return (host == suffix) | host.endswith("." + suffix)


# Endings of paths that are no HTML.
SKIPPED_ENDINGS = (
    ".pdf", ".doc", ".docx", ".xls", ".xlsx", ".zip", ".rar", ".7z",
    ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".ico",
    ".mp4", ".mp3", ".avi", ".mov", ".css", ".js",
)


def is_binary_url(url: Column) -> Column:
    path = F.substring_index(F.lower(url), "?", 1)
    return path.rlike("(?s)(?:" + "|".join(e.replace(".", r"\.") for e in SKIPPED_ENDINGS) + r")\z")


def without_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)
