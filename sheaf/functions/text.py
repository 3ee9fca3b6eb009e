"""Text rules as Column expressions: no Python code runs on the executors."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.vocabulary import ANSWER_KEY_NEEDS, ANSWER_KEY_PATTERNS, DIGIT, LATEX, LETTER_ANSWERS, OCR_LITERALS, PAGE_ANSWERS, PAGE_SIGNS, SUBJECT_CODES

#: Fixed value: what counts as space at either end: tab to return, space, and Unicode's spaces and line ends.
SPACE_LETTERS = "\t\n\x0b\x0c\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def literal(pattern: str) -> str:
    """A pattern for Java that matches the string itself."""
    return re.sub(r"([.*+?^${}()|\[\]\\])", r"\\\1", pattern)


def wide_trim(x: Column | str) -> Column:
    """Trims all Unicode spaces and line ends, not only U+0020. A plain trim by a set: it looks at the ends only, where a pattern would go through the text."""
    return F.btrim(_c(x), F.lit(SPACE_LETTERS))


def is_blank(x: Column | str) -> Column:
    return F.coalesce(wide_trim(x), F.lit("")) == ""


def prefix_int(x: Column | str) -> Column:
    """The whole number a text begins with, or null; never an error."""
    return F.regexp_extract(_c(x), r"^\s*([+-]?\d+)", 1).try_cast("int")


def prefix_double(x: Column | str) -> Column:
    return F.regexp_extract(_c(x), r"^\s*([+-]?(?:\d+\.?\d*(?:[eE][+-]?\d+)?|\.\d+))", 1).try_cast("double")


def ocr_fixed(x: Column | str) -> Column:
    """Ligatures, dashes, line ends and runs of blanks."""
    x = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), OCR_LITERALS.items(), _c(x))
    for pattern, new in ((r"\r\n", "\n"), (r"\r", "\n"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")):
        x = F.regexp_replace(x, pattern, new)
    return x


#: Fixed values.
_GROUPS = ((r"\\frac\{([^}]+)\}\{([^}]+)\}", "$1/$2"), (r"\\sqrt\{([^}]+)\}", "√($1)"), (r"\^\{([^}]+)\}", "^($1)"))
_PLAIN = tuple((rf"\\{name}\{{([^}}]+)\}}", "$1") for name in ("text", "mathrm", "textbf", "textit"))
_BRACES = ((r"\{([^}]+)\}", "$1"),)


def normalize_latex(x: Column | str, compat: bool = False) -> Column:
    """LaTeX to Unicode. The default takes the named groups first and the longest commands first; compat keeps the published order, in which some rules can't apply."""
    x = ocr_fixed(x)
    commands = list(LATEX.items()) if compat else sorted(LATEX.items(), key=lambda kv: -len(kv[0]))
    groups = (*_GROUPS, *_BRACES, *_PLAIN) if compat else (*_GROUPS, *_PLAIN, *_BRACES)
    replaced = lambda c: reduce(lambda a, kv: F.replace(a, F.lit(kv[0]), F.lit(kv[1])), commands, c)
    grouped = lambda c: reduce(lambda a, kv: F.regexp_replace(a, kv[0], kv[1]), groups, c)
    return wide_trim(grouped(replaced(x)) if compat else replaced(grouped(x)))


def has_answer_key(x: Column | str, patterns: list[str] = ANSWER_KEY_PATTERNS) -> Column:
    """Whether any pattern occurs. A pattern is looked for only in texts that hold what it needs, which is a plain search."""
    low = F.lower(_c(x))
    needs = dict(zip(ANSWER_KEY_PATTERNS, ANSWER_KEY_NEEDS, strict=True))
    holds = lambda p: F.lit(True) if p not in needs else _c(x).rlike("[0-9]") if needs[p] == DIGIT else low.contains(needs[p])
    return reduce(lambda a, b: a | b, [F.coalesce(holds(p) & _c(x).rlike(p), F.lit(False)) for p in patterns])


def answer_count(x: Column | str) -> Column:
    low = F.lower(_c(x))
    return reduce(lambda a, b: a + b, [F.regexp_count(low, F.lit(p)) for p in PAGE_ANSWERS])


def answer_key_score(x: Column | str) -> Column:
    """From 5 on a page counts as an answer key."""
    low, n = F.lower(_c(x)), answer_count(x)
    signs = [F.when(low.rlike(p), s).otherwise(0) for p, s in PAGE_SIGNS]
    return reduce(lambda a, b: a + b, signs) + F.when(n >= 20, 4).when(n >= 10, 2).otherwise(0)


def is_bilingual(x: Column | str) -> Column:
    """Both Devanagari and Latin letters occur."""
    return _c(x).rlike(r"[\u0900-\u097F]") & _c(x).rlike("[a-zA-Z]")


def devanagari_ratio(x: Column | str) -> Column:
    hi, en = F.regexp_count(_c(x), F.lit(r"[\u0900-\u097F]")), F.regexp_count(_c(x), F.lit("[a-zA-Z]"))
    return F.when(hi + en > 0, hi / (hi + en))


def normalize_answer(answer: Column | str, n_options: Column | str) -> Column:
    """Letters to indexes, 1-based to 0-based if there are four options; other answers as they are."""
    raw = F.coalesce(_c(answer), F.lit(""))
    key = F.regexp_replace(F.lower(wide_trim(raw)), "[()]", "")
    letters = F.create_map(*[F.lit(v) for kv in LETTER_ANSWERS.items() for v in kv])
    return F.when(raw == "", raw).when(key.isin(*LETTER_ANSWERS), letters[key]).when(key.isin("1", "2", "3", "4") & (_c(n_options) == 4), (key.try_cast("int") - 1).cast("string")).when(key.isin("0", "1", "2", "3"), key).otherwise(raw)


def assign_section(section: Column | str, number: Column | str) -> Column:
    n = _c(number)
    return F.when(F.coalesce(_c(section), F.lit("")) != "", _c(section)).when(n.between(1, 100), "a").when(n.between(101, 200), "b").otherwise(_c(section))


def repair_options(options: Column | str) -> Column:
    """Splits options that hold several; more than six afterwards: the original ones."""
    parts = lambda o: F.split(o, r"(?=\([1-6]\)\s*|\([A-F]\)\s*|\d[.)]\s+[A-Z])")
    fixed = F.flatten(F.transform(_c(options), lambda o: F.when(F.size(parts(o)) > 1, F.filter(F.transform(parts(o), wide_trim), lambda p: F.length(p) > 3)).otherwise(F.array(o))))
    return F.when(F.size(fixed) > 6, _c(options)).otherwise(fixed)


def described_options(x: Column | str) -> Column:
    """Four options named in a description, or null."""
    letters = F.transform(F.regexp_extract_all(_c(x), F.lit(r"(?:^|[;.])\s*[A-D][.)]\s*([^;.]+)"), F.lit(1)), wide_trim)
    letters = F.filter(letters, lambda o: F.length(o) > 1)
    named = F.transform(F.regexp_extract_all(_c(x), F.lit(r"(?i)Option\s+[A-D]\s*[:.)]\s*([^;.]+)"), F.lit(1)), wide_trim)
    return F.when(F.size(letters) == 4, letters).when(F.size(named) == 4, named)


#: Fixed value.
IMAGE = r"!\[([^\]]*)\]\(([^\)]+)\)"


def image_refs(x: Column | str) -> Column:
    """Array of (label, filename)."""
    label, file = F.regexp_extract_all(_c(x), F.lit(IMAGE), F.lit(1)), F.regexp_extract_all(_c(x), F.lit(IMAGE), F.lit(2))
    return F.zip_with(label, file, lambda a, b: F.struct(F.nullif(a, F.lit("")).alias("label"), b.alias("filename")))


def image_caption(x: Column | str, image: Column | str) -> Column:
    """The line after the last one that names the image, if it is 6 to 199 characters long."""
    lines = F.split(_c(x), "\n")
    following = F.transform(lines, lambda line, i: F.when(line.contains(_c(image)), wide_trim(F.get(lines, i + 1))))
    good = F.filter(following, lambda c: F.length(c).between(6, 199))
    return F.get(good, F.lit(0))


#: Fixed value.
DIAGRAM_WORDS = r"(?i)(Figure|Fig\.?|Diagram|Graph|Circuit|shown\s+in|figure\s+\d|diagram\s+\d)"


def mentions_diagram(x: Column | str) -> Column:
    return F.coalesce(_c(x).rlike(DIAGRAM_WORDS), F.lit(False))


def has_html(x: Column | str) -> Column:
    return F.coalesce(_c(x).rlike(r"(?is)<script|</?[a-z].*>"), F.lit(False))


def is_broken(x: Column | str) -> Column:
    return F.coalesce(_c(x).rlike(r"[\uFFFD\x00-\x08\x0B\x0C\x0E-\x1F]"), F.lit(False))


def escape_html(x: Column | str) -> Column:
    return reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")), _c(x))


def hash31(x: Column | str) -> Column:
    """The 32-bit hash h * 31 + character, over code points."""
    signed = lambda v: F.when(v >= 2**31, v - F.lit(2**32)).otherwise(v)
    step = lambda h, c: F.pmod(h * 31 + F.ascii(c), F.lit(2**32))
    return signed(F.aggregate(F.filter(F.split(_c(x), ""), lambda c: c != ""), F.lit(0).cast("long"), step))


def short_shift(x: Column | str) -> Column:
    digits = F.lower(F.conv(F.abs(hash31(x)).cast("string"), 10, 36))
    return F.when(F.length(_c(x)) <= 15, _c(x)).otherwise(F.substring(digits, 1, 8))


def shift_code(shift: Column | str) -> Column:
    """A shift's short code in ids."""
    low = F.lower(wide_trim(shift))

    def numbered(n: int) -> Column:
        return F.concat(wide_trim(F.regexp_replace(F.regexp_replace(low, f"shift{n}|-s{n}|s{n}", ""), "-+", "")), F.lit(f"-s{n}"))

    has = lambda n: low.contains(f"shift{n}") | low.contains(f"-s{n}") | low.endswith(f"s{n}")
    paper = lambda n: low.contains(f"paper{n}") | low.contains(f"-p{n}")
    digits = F.regexp_extract(low, r"(\d+)", 1)
    return F.when(F.coalesce(_c(shift), F.lit("")) == "", "na").when(has(1), numbered(1)).when(has(2), numbered(2)).when(paper(1), "p1").when(paper(2), "p2").when(digits != "", F.concat(F.lit("s"), digits)).otherwise(short_shift(low))


def subject_code(subject: Column | str) -> Column:
    codes = F.create_map(*[F.lit(v) for kv in SUBJECT_CODES.items() for v in kv])
    return F.coalesce(codes[F.coalesce(_c(subject), F.lit(""))], F.lit("xx"))


def question_id(exam: Column | str, year: Column | str, shift: Column | str, subject: Column | str, number: Column | str) -> Column:
    """exam-year-shift-code-nnn; longer numbers aren't cut."""
    return F.concat_ws("-", _c(exam), F.coalesce(_c(year), F.lit(0)).cast("string"), shift_code(shift), subject_code(subject), F.format_string("%03d", _c(number).cast("long")))


def question_hash(text: Column | str, options: Column | str) -> Column:
    body = F.lower(F.trim(F.regexp_replace(_c(text), r"\s+", " ")))
    return F.sha2(F.concat(body, F.lit("||"), F.coalesce(F.array_join(_c(options), "|"), F.lit(""))), 256)


def word_list(x: Column | str) -> Column:
    """ASCII words of three characters or more."""
    return F.filter(F.split(F.lower(_c(x)), r"\W+"), lambda w: F.length(w) > 2)


def word_set(x: Column | str) -> Column:
    """The same, each once."""
    return F.array_distinct(word_list(x))


def jaccard(a: Column, b: Column) -> Column:
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Of arrays of numbers; 0 if either is zero, null if their lengths differ."""
    a, b = _c(a), _c(b)
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(F.size(a) == F.size(b), F.when(norms == 0, 0.0).otherwise(dot(a, b) / norms))


def plain(x: Column | str, kind: str = "string") -> Column:
    """How two values are compared: null as empty, arrays as JSON of trimmed elements, others trimmed."""
    if kind == "array":
        return F.coalesce(F.to_json(F.transform(_c(x), wide_trim)), F.lit(""))
    return F.coalesce(wide_trim(_c(x).cast("string")), F.lit(""))


def size_label(n: Column | str) -> Column:
    return F.when(_c(n) < 1024, F.concat(_c(n).cast("string"), F.lit(" B"))).when(_c(n) < 1048576, F.format_string("%.1f KB", _c(n) / 1024)).otherwise(F.format_string("%.1f MB", _c(n) / 1048576))


def file_size_label(kb: Column | str) -> Column:
    """Whole kilobytes, as megabytes beyond 1024."""
    return F.when(_c(kb) > 1024, F.format_string("%.1f MB", _c(kb) / 1024)).otherwise(F.concat(_c(kb).cast("string"), F.lit(" KB")))


def image_bytes(x: Column | str) -> Column:
    """An image from base64, with or without a data URI before it; null if it isn't base64."""
    return F.try_to_binary(F.regexp_replace(_c(x), r"^data:[^,]*,", ""), F.lit("base64"))


#: Mathematics between double dollars is displayed, between single ones it stands in the line.
DISPLAYED, INLINE = r"\$\$([^$]+)\$\$", r"\$([^$]+)\$"


def math_spans(x: Column | str) -> Column:
    """Array of (displayed, body) of a text's mathematics: displayed ones first, then those in lines, trimmed."""
    rest = F.regexp_replace(_c(x), DISPLAYED, "")
    spans = lambda c, p, shown: F.transform(F.regexp_extract_all(c, F.lit(p), F.lit(1)), lambda m: F.struct(F.lit(shown).alias("displayed"), wide_trim(m).alias("body")))
    return F.concat(spans(_c(x), DISPLAYED, True), spans(rest, INLINE, False))


#: What stands out in a log line.
LOG_LEVEL, LOG_STEP, LOG_TIME = r"\[(ERROR|WARN|INFO|DEBUG)\]", r"Step (\d/\d):", r"(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z)"
LOG_NUMBERS = r"\b(\d{1,3}/\d{1,3}|\d+ pages|\d+ chars|\d+ questions|\+[\d.]+s)\b"


def log_tokens(x: Column | str) -> Column:
    """(level, step, at, numbers) of a log line; null where a part is missing."""
    part = lambda p: F.nullif(F.regexp_extract(_c(x), p, 1), F.lit(""))
    return F.struct(part(LOG_LEVEL).alias("level"), part(LOG_STEP).alias("step"), part(LOG_TIME).alias("at"), F.regexp_extract_all(_c(x), F.lit(LOG_NUMBERS), F.lit(1)).alias("numbers"))
