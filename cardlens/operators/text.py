"""Text evidence: slots of numbers and units, containment and similarity, segments, repairs."""

from __future__ import annotations

import difflib
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cardlens.functions import scalars as S

NUMBER = r"[-+]?[0-9]+(?:\.[0-9]+)?"
UNIT = "(?i)(℃|°c|％|%|元|¥|￥|分钟|小时|分|h|hr|hour|min|mins|摄氏度|度)"
#: Spellings of a unit by its normal form.
UNITS = {"℃": ["℃", "°c", "c", "摄氏度", "度"], "%": ["%", "％", "percent", "百分比"], "元": ["元", "¥", "￥", "rmb"], "分": ["分", "分钟", "min", "mins"], "h": ["h", "hr", "hour", "小时"]}


def normalize_number(x: Column) -> Column:
    """A number without trailing zeros: 25.50 is 25.5, 7.0 is 7."""
    plain = F.regexp_replace(x, r"^\+", "")
    plain = F.when(plain.contains("."), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")).otherwise(plain)
    plain = F.regexp_replace(plain, r"^(-?)0+(?=[0-9])", "$1")
    return F.when(plain.isin("-0", ""), "0").otherwise(plain)


def normalize_unit(x: Column) -> Column:
    raw = F.lower(F.trim(x))
    out = raw
    for name, spellings in UNITS.items():
        out = F.when(raw.isin([s for s in spellings if s != "c"]), name).otherwise(out)
    return out


def text_slots(text: Column) -> Column:
    """struct(numbers, units): what a text says, in order, in normal form."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(f"({NUMBER})"), F.lit(1)), normalize_number)
    units = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(1)), normalize_unit)
    return F.struct(numbers.alias("numbers"), units.alias("units"))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of normalised texts."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def containment(a: Column, b: Column) -> Column:
    """Length ratio of two normalised texts if one holds the other; else null; 0 if one is empty."""
    n, m = F.length(a), F.length(b)
    return F.when((n == 0) | (m == 0), 0.0).when(F.contains(a, b) | F.contains(b, a), F.least(n, m) / F.greatest(n, m))


def likeness(x: Column, y: Column) -> Column:
    """The similarity of two normalised texts; they are matched only if neither holds the other."""
    held = containment(x, y)
    return F.coalesce(held, sequence_ratio(F.when(held.isNull(), x), F.when(held.isNull(), y)))


def similarity(a: Column, b: Column) -> Column:
    return likeness(S.normalize_text(a), S.normalize_text(b))


#: Classes of characters whose counts bound a similarity.
_CLASSES = 8


def _class_counts(x: Column) -> Column:
    """How many characters of each class (code point modulo ``_CLASSES``) a text has."""
    classes = F.transform(F.split(x, ""), lambda c: F.ascii(c) % _CLASSES)
    return F.transform(F.sequence(F.lit(0), F.lit(_CLASSES - 1)), lambda k: F.size(F.filter(classes, lambda c: c == k)))


def sized(x: Column) -> Column:
    """What ``may_reach`` needs of a normalised text, computed before texts are paired."""
    return F.struct(F.length(x).alias("n"), _class_counts(x).alias("counts"))


def may_reach(a: Column, b: Column, least: float) -> Column:
    """False for two texts (see ``sized``) whose similarity can't reach ``least``: twice the characters that two texts have in
    common by class, over all of theirs, bounds it from above, and so does the same by length."""
    shared = F.aggregate(F.zip_with(a["counts"], b["counts"], lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)
    share = lambda x: F.coalesce(F.try_divide(2 * x, a["n"] + b["n"]), F.lit(0.0)) >= least  # noqa: E731 (divided as the similarity is)
    return share(F.least(a["n"], b["n"])) & share(shared)


def best_match(required: DataFrame, seen: DataFrame, least_share: float = 0.5) -> DataFrame:
    """required (key, id, text) x seen (key, ord, text) of the same key: id, ord, similarity of the
    likest, the first of equals; no ord and 0 where none is likely enough.

    Twice the characters that two texts have in common, over all of theirs, bounds the similarity
    from above; so does the same sum over classes of characters, or over lengths alone. Pairs that
    cannot reach ``least_share`` are left out before texts are compared.
    """
    a = required.select("key", "id", S.normalize_text(F.col("text")).alias("a")).withColumn("sa", sized(F.col("a")))
    b = seen.select("key", "ord", S.normalize_text(F.col("text")).alias("b")).withColumn("sb", sized(F.col("b")))
    pairs = a.join(b, "key").filter(may_reach(F.col("sa"), F.col("sb"), least_share))
    scored = pairs.withColumn("s", likeness(F.col("a"), F.col("b")))
    best = scored.groupBy("id").agg(F.max(F.struct("s", (-F.col("ord")).alias("o"))).alias("m"))
    best = best.select("id", (-F.col("m.o")).alias("ord"), F.col("m.s").alias("similarity"))
    return required.select("id").join(best, "id", "left").select("id", "ord", F.coalesce("similarity", F.lit(0.0)).alias("similarity"))


#: Fixed value: from this similarity on, a text is taken for the required one.
SAME = 0.9


def slot_coverage(required: DataFrame, seen: DataFrame) -> DataFrame:
    """id, status, score of required (key, id, text) against all text seen (key, ord, text) under its key.

    In this order: contained in the texts as a whole, or nearly the same as one of them; numbers
    without units; numbers; missing.
    """
    joined = seen.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x["text"]), " ").alias("all"))
    out = required.join(joined, "key", "left").withColumn("all", S.normalize_text(F.col("all"))).withColumn("norm", S.normalize_text(F.col("text")))
    inside = (F.length("norm") >= 2) & F.contains(F.col("all"), F.col("norm"))
    out = out.withColumn("inside", F.coalesce(inside, F.lit(False)))
    near = best_match(out.filter("NOT inside").select("key", "id", "text"), seen, SAME).filter(F.col("similarity") >= SAME)
    out = out.join(near.select("id", F.lit(True).alias("near")), "id", "left").withColumn("slots", text_slots(F.coalesce("text", F.lit(""))))
    numbers, units = F.col("slots.numbers"), F.col("slots.units")
    found = F.forall(numbers, lambda n: F.contains(F.col("all"), S.normalize_text(n)))

    def unit_found(u: Column) -> Column:
        hit = F.contains(F.col("all"), S.normalize_text(u))
        for name, spellings in UNITS.items():
            any_of = F.lit(False)
            for s in spellings:
                any_of = any_of | F.contains(F.col("all"), F.lit(s))
            hit = F.when(u == name, any_of).otherwise(hit)
        return hit

    has = F.size(numbers) > 0
    status = (
        F.when(F.col("inside") | F.col("near"), "pass")
        .when(has & found & (F.size(units) > 0) & ~F.forall(units, unit_found), "weak_pass")
        .when(has & found, "numeric_pass")
        .otherwise("missing")
    )
    score = F.when(status == "pass", 1.0).when(status == "weak_pass", 0.75).when(status == "numeric_pass", 0.85).otherwise(0.0)
    return out.select("id", status.alias("status"), score.alias("score"))


def display_texts(x: Column) -> Column:
    """White space made single; null for marks of one or two characters that are no letter or digit."""
    def shown(text: Column) -> Column:
        decorative = (F.length(text) <= 2) & ~text.rlike(r"[A-Za-z0-9㐀-鿿]")
        return F.when((text != "") & ~decorative, text)

    return S.once(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")), shown)


def strip_fence(x: Column, language: str = "") -> Column:
    """The body of the first fenced block of the language; the text itself if there is none."""
    body = F.regexp_extract(x, rf"(?i)```{language}[^\n]*\n((?:[^`]++|`(?!``))*+)```", 1)
    found = F.get(F.filter(F.array(body), lambda b: b != ""), F.lit(0))  # the pattern is run once
    return F.coalesce(F.when(x.contains("```"), found), x)


def record_segments(text: Column, operation: str = "[A-Za-z]+") -> Column:
    """The text cut before every record head ``{"version":"...","<op>":``; what precedes the first is left out."""
    head = rf'\{{\s*"version"\s*:\s*"[^"]*"\s*,\s*"(?:{operation})"\s*:'
    return F.filter(F.split(text, f"(?={head})"), lambda s: s.rlike(f"^{head}"))


def balance(text: str) -> str:
    """JSON text with open strings and brackets closed and stray closers left out."""
    out, stack, quoted, escaped = [], [], False, False
    for c in text:
        if quoted:
            quoted = escaped or c != '"'
            escaped = c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
        elif c in "}]":
            if not stack or stack[-1] != c:
                continue
            stack.pop()
        out.append(c)
    return "".join(out) + '"' * quoted + "".join(reversed(stack))


def _records(text: str) -> list[str]:
    for candidate in (text, balance(text)):
        try:
            value, _ = json.JSONDecoder().raw_decode(candidate.strip())
        except ValueError:
            continue
        rows = value if isinstance(value, list) else [value]
        return [json.dumps(r, sort_keys=True, ensure_ascii=False, separators=(",", ":")) for r in rows if isinstance(r, dict)]
    return []


def repair_records(texts: DataFrame) -> DataFrame:
    """(id, text) to (id, n, record): the JSON objects of a text as canonical JSON, each once, in order.

    Fenced blocks are opened; text that doesn't parse is cut at record heads, balanced, and read by
    the longest prefix that parses. A text without an object gives no row.
    """
    head = re.compile(r'(?=\{\s*"version"\s*:\s*"[^"]*"\s*,\s*"\w+"\s*:)')

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for i, text in zip(batch["id"], batch["text"]):
                text = re.sub(r"```[^\n]*\n?", "", text or "").lstrip("﻿").strip()
                found = _records(text) if text[:1] in "[{" else []
                parts = [p for p in head.split(text) if p.startswith("{")]
                if len(parts) > 1 or not found:
                    found = [r for p in parts for r in _records(p)] or found
                rows += [(i, n, r) for n, r in enumerate(dict.fromkeys(found))]
            yield pd.DataFrame(rows, columns=["id", "n", "record"])

    return texts.select("id", "text").mapInPandas(run, "id long, n long, record string")


def fingerprint(json: Column) -> Column:
    """A digest of JSON text by its content: keys sorted, white space between tokens left out. Text
    that is no JSON stands for itself."""
    return F.sha2(F.coalesce(F.to_json(F.try_parse_json(json)), json), 256)


def distinct_records(records: DataFrame, key: str, order: str) -> DataFrame:
    """The first row, by ``order``, of each distinct record. Partial sums keep one row a record and task."""
    row = F.struct(*[F.col(c) for c in records.columns])
    first = records.groupBy(fingerprint(F.col(key)).alias("_f")).agg(F.min_by(row, order).alias("_r"))
    return first.select("_r.*")


def extract_url(line: Column, suffixes: str = r"[^\s\"'<>]*") -> Column:
    """The first URL of a line: from a quoted result, a result label, or bare; closers trimmed."""
    url = F.coalesce(
        F.nullif(F.regexp_extract(line, r'"result"\s*:\s*"(https?:[^"]+)"', 1), F.lit("")),
        F.nullif(F.regexp_extract(line, r"result:\s*(https?:\S+)", 1), F.lit("")),
        F.nullif(F.regexp_extract(line, rf"(https?://{suffixes})", 1), F.lit("")),
    )
    return F.regexp_replace(F.regexp_replace(url, r"\\/", "/"), r"[)\]}>,;'\"\\]+$", "")


def scene_of(qid: Column) -> Column:
    """The scene that a name ends with, as in prefix__Case-29-elderly-care-008."""
    return F.coalesce(F.nullif(F.regexp_extract(qid, r"Case-[0-9]+-(.+?)-[0-9]+$", 1), F.lit("")), F.lit("unknown"))


# The longest text of a cell, and what a shortened one ends with.
CELL_LIMIT = 32_000
CUT_MARK = "\n... [内容过长已截断，完整见 {name}]"


def cell_text(text: Column, name: Column) -> Column:
    """Text as a spreadsheet cell takes it; what is cut is said, with the name of the whole."""
    before, after = CUT_MARK.split("{name}")
    cut = F.concat(F.substring(text, 1, CELL_LIMIT), F.lit(before), name, F.lit(after))
    return F.when(F.length(text) > CELL_LIMIT, cut).otherwise(text)
