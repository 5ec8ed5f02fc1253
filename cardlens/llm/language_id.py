"""Language identification by multilingual mixture inference.

Every language has a distribution over hashed character n-grams (of one to ``GRAM`` letters
within words), counted over all labelled documents. A document is a mixture of languages:
expectation-maximisation finds the proportions under which its n-grams are likeliest. Which
languages are in the mixture is decided by penalised likelihood: the languages in the order of
their proportions form nested sets, each is fitted again, and the set with the best likelihood
less ``penalty`` * log(n-grams) for each language is taken. The prediction is the language with
the largest proportion.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint, fresh

BUCKETS = 1 << 15
GRAM = 3
#: Most languages that a model may hold; with BUCKETS this bounds what is broadcast.
MOST_LANGUAGES = 512
UNKNOWN = "und"
_CHUNK = 1 << 18


def _spaced(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, which are letters) of ``text`` in lower case, anything but letters being a
    space, with single spaces between words and one on either side; in pieces of bounded size."""
    text, gap = text.lower(), True
    for i in range(0, len(text), _CHUNK):
        points = np.frombuffer(text[i : i + _CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        values, at = np.unique(points, return_inverse=True)
        letters = np.array([chr(v).isalpha() if not 0xD800 <= v < 0xE000 else False for v in values.tolist()])
        letter = letters[at]
        keep = letter | np.r_[not gap, letter[:-1]]
        gap = not letter[-1]
        points, letter = np.where(letter, points, 32).astype(np.uint64)[keep], letter[keep]
        if i == 0:
            points, letter = np.r_[np.uint64(32), points], np.r_[False, letter]
        if i + _CHUNK >= len(text):
            end = [] if gap else [32]
            points, letter = np.r_[points, np.array(end, np.uint64)], np.r_[letter, np.zeros(len(end), bool)]
        yield points, letter


def gram_buckets(text: str) -> Iterator[np.ndarray]:
    """Hash buckets of the n-grams of ``text``, in pieces of bounded size; n-grams of spaces alone
    are left out. The last code points of a piece go on to the next, so none is lost or made."""
    held, held_letter = np.empty(0, np.uint64), np.empty(0, bool)
    for points, letter in _spaced(text):
        old = len(held)
        points, letter = np.r_[held, points], np.r_[held_letter, letter]
        out = []
        for n in range(1, GRAM + 1):
            first = max(old - n + 1, 0)  # n-grams that end in this piece
            h = np.full(max(len(points) - n + 1 - first, 0), np.uint64(n))
            some = np.zeros(len(h), bool)
            for i in range(n):
                h = h * np.uint64(0x9E3779B97F4A7C15) + points[first + i : first + len(h) + i]
                some |= letter[first + i : first + len(h) + i]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            out.append(((h >> np.uint64(32)) % np.uint64(BUCKETS))[some].astype(np.int64))
        held, held_letter = points[-(GRAM - 1) :], letter[-(GRAM - 1) :]
        yield np.concatenate(out)


def bucket_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, how often) over the whole text."""
    if len(text) <= _CHUNK:
        return np.unique(np.concatenate([*gram_buckets(text), np.empty(0, np.int64)]), return_counts=True)
    n = sum(np.bincount(b, minlength=BUCKETS) for b in gram_buckets(text))
    some = np.flatnonzero(n)
    return some, n[some]


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [buckets, languages]) from all rows with a language.

    Tasks count in arrays of fixed size and hand on one row for each language and bucket, which
    Spark adds up; the driver gets at most ``MOST_LANGUAGES * BUCKETS`` sums.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                if lang not in sums:
                    if len(sums) >= MOST_LANGUAGES:
                        raise ValueError(f"more than {MOST_LANGUAGES} languages")
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                for b in gram_buckets(text.as_py() or ""):
                    sums[lang] += np.bincount(b, minlength=BUCKETS)
        for lang, n in sums.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(n[some])], ["lang", "bucket", "n"])

    rows = docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    sums = checkpoint(sums)
    named = sums.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(named) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [r["lang"] for r in named]
    table = sums.toArrow()
    n = np.zeros((BUCKETS, len(languages)))
    at = pc.index_in(table["lang"], pa.array(languages, pa.string())).to_numpy()
    n[table["bucket"].to_numpy(), at] = table["n"].to_numpy()
    return languages, np.log((n + 0.1) / (n.sum(axis=0) + 0.1 * BUCKETS)).astype(np.float32)


def _mixture(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """EM for the proportions: (proportions, log-likelihood). ``p``: n-grams by languages, each
    row scaled to a greatest value of 1."""
    share = start
    for _ in range(rounds):
        mixed = p @ share
        new = share * (p.T @ (n / mixed)) / n.sum()
        done = np.abs(new - share).max() < 1e-3
        share = new
        if done:
            break
    return share, float(n @ np.log(p @ share))


def infer(log_p: np.ndarray, text: str, penalty: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """(proportions over the languages, share of the first's certainty) of a text with letters.

    The second value is how much likelier the whole text is under its first language than under
    all (0 to 1); it matters only for very short texts.
    """
    bucket, n = bucket_counts(text)
    logs = log_p[bucket].astype(np.float64)
    top = logs.max(axis=1)
    p, n = np.exp(logs - top[:, None]), n.astype(np.float64)
    single = n @ (logs - top[:, None])
    k = log_p.shape[1]
    certain = np.exp(single - single.max())
    cost = penalty * np.log(n.sum() + 1)
    best, best_value = np.zeros(k), single.max() - cost
    best[single.argmax()] = 1.0
    share, value = _mixture(p, n, np.full(k, 1 / k), rounds)
    if k > 1 and value - 2 * cost > best_value:  # no set of several languages can do better than all
        order = np.argsort(-share, kind="stable")
        for size in range(2, k + 1):
            if value - size * cost <= best_value:
                break
            chosen = order[:size]
            part, fitted = _mixture(p[:, chosen], n, np.full(size, 1 / size), rounds)
            if fitted - size * cost > best_value:
                best, best_value = np.zeros(k), fitted - size * cost
                best[chosen] = part
    return best, float(certain[best.argmax()] / certain.sum()) if (best > 0).sum() == 1 else 1.0


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", penalty: float = 1.0) -> DataFrame:
    """``docs`` with lang_pred, score and lang_shares (map of the chosen set) added or replaced.

    Only the text is looked at. ``und`` with score 0 is for null texts, texts without a letter,
    and a model without languages. The score is the first language's proportion, times its
    certainty where the set is that language alone. Ties go to the first language by name.
    """
    languages, log_p = model
    wide = docs.sparkSession.sparkContext.broadcast(log_p)  # at most MOST_LANGUAGES * BUCKETS floats
    added = ("lang_pred", "score", "lang_shares")
    kept = [c for c in docs.columns if c not in added]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = wide.value
        for batch in batches:
            pred, score, shares = [], [], []
            for text in batch.column(text_col):
                text = text.as_py()
                if not languages or not text or not any(map(str.isalpha, text)):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    shares.append([])
                    continue
                share, certain = infer(log_p, text, penalty)
                pred.append(languages[int(share.argmax())])
                score.append(min(1.0, float(share.max()) * certain))
                shares.append([(languages[j], float(share[j])) for j in np.flatnonzero(share)])
            out = [batch.column(c) for c in kept] + [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, [*kept, *added])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double, lang_shares map<string,double>")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", penalty: float = 1.0) -> DataFrame:
    """Learn from the documents that aren't held out, predict all: ``docs`` with held_out,
    lang_pred, score, lang_shares. Repeated rows are predicted alike; an empty table stays empty."""
    model = learn(docs.filter(~held_out(id_col)), lang_col, text_col)
    return predict(docs.withColumn("held_out", held_out(id_col)), model, id_col, text_col, penalty)


def keep_identified(docs: DataFrame, least: float = 0.3, **columns: str) -> DataFrame:
    """The rows of ``docs``, columns as they are, with a known language of score ``least`` or more."""
    own = {c: fresh(docs, f"_own_{c}") for c in docs.columns if c.lower() in ("held_out", "lang_pred", "score", "lang_shares")}
    named = identify(docs.withColumnsRenamed(own), **columns)
    kept = named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])
