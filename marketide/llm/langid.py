"""Language identification by rank-order profiles.

A profile lists the most frequent n-grams (one to three letters, with word ends) of a
language by rank. A text's own profile is compared with each: every n-gram adds the
distance between its two ranks, or PROFILE if the language's profile lacks it. The
nearest language wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marketide.llm import pretokens
from marketide.llm.bpe import text_batches
from marketide.llm.tables import texts

#: N-grams in a profile.
PROFILE = 400
UNKNOWN = "und"
#: Distinct n-grams a task gathers before it hands them on.
GATHERED = 500_000


def count_ngrams(items: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, key of an n-gram), ordered, and how often each occurs; ``groups`` has one for each text.

    A key holds up to three code points of 21 bits, 0 for a word end; two-letter keys end in 1 << 20.
    """
    lowered = [t.lower() for t in items]
    points = pretokens.code_points("\0" + "\0".join(lowered) + "\0")
    owners = np.repeat(groups, [len(t) + 1 for t in lowered])
    owners = np.append(owners, groups[-1:])
    letters = pretokens.classes()[points] == pretokens.LETTER
    # One word end between words is enough.
    stay = letters.copy()
    stay[1:] |= letters[:-1]
    stay[0] = True
    points, owners, letters = np.where(letters, points, 0)[stay], owners[stay], letters[stay]
    if len(points) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Numbers of the batch's own letters keep keys small enough to be sorted along with their group.
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.append(np.flatnonzero(seen), 1 << 20)
    number = np.zeros(0x110000, np.int64)
    number[alphabet[:-1]] = np.arange(len(alphabet) - 1)
    base = len(alphabet)
    if base ** 3 * (int(groups.max()) + 1) >= 1 << 62:
        return _in_halves(items, groups)
    p = number[points]
    pairs = p[:-1] * base + p[1:]
    codes = (p * base * base)[letters], (pairs * base + base - 1)[letters[:-1] | letters[1:]], (pairs[:-1] * base + p[2:])[letters[1:-1]]
    # A word end before a letter may stand for the text before; the letter knows its text.
    of = owners[letters], np.where(letters[:-1], owners[:-1], owners[1:])[letters[:-1] | letters[1:]], owners[1:-1][letters[1:-1]]
    found = np.sort(np.concatenate(of) * base ** 3 + np.concatenate(codes))
    first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
    group, code = np.divmod(found[first], base ** 3)
    keys = (alphabet[code // base ** 2] << 42) | (alphabet[code // base % base] << 21) | alphabet[code % base]
    return group, keys, np.diff(first, append=len(found))


def _in_halves(items: list[str], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``count_ngrams``, for batches with too many letters and groups at once; one text alone never has."""
    middle = len(items) // 2
    if not middle:
        group, keys, counts = count_ngrams(items, np.zeros(1, np.int64))
        return group + groups[0], keys, counts
    parts = [count_ngrams(items[s], groups[s]) for s in (slice(None, middle), slice(middle, None))]
    group, keys, counts = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((keys, group))
    group, keys, counts = group[order], keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])]))
    return group[first], keys[first], np.add.reduceat(counts, first) if len(first) else counts


def profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """lang, key, rank (from 0): the ``size`` most frequent n-grams of all texts of a language.

    Rows without text or lang teach nothing; equal counts rank by key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        gathered = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in found.items():
                keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                totals = np.bincount(which, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(totals)], ["lang", "key", "n"]
                )
            found.clear()

        for rows, items in text_batches(batches):
            langs = rows.column(rows.schema.get_field_index("lang")).to_pylist()
            names = sorted(set(langs))
            code = {name: i for i, name in enumerate(names)}
            groups, keys, counts = count_ngrams(items, np.array([code[x] for x in langs]))
            if not len(keys):
                continue
            for i, name in enumerate(names):
                own = groups == i
                if own.any():
                    found.setdefault(name, []).append((keys[own], counts[own]))
            gathered += len(keys)
            if gathered > GATHERED:
                yield from flush()
                gathered = 0
        yield from flush()

    taught = texts(docs.where("text IS NOT NULL AND lang IS NOT NULL"), F.col("lang").cast("string").alias("lang"))
    counts = taught.select("text", "lang").mapInArrow(run, "lang string, key long, n long")
    totals = counts.groupBy("lang", "key").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    return totals.withColumn("rank", rank - 1).where(F.col("rank") < size).select("lang", "key", "rank")


def predict(docs: DataFrame, learned: DataFrame, size: int = PROFILE) -> DataFrame:
    """doc_id, lang_pred and score of every text.

    The score is 1 - distance / greatest possible distance. Texts that are null or have no
    letter get ``und`` and 0, and so do all texts if nothing was learned. Equal distances
    go to the language that sorts first. Rows that repeat a doc_id get a row each.
    """
    return annotate(texts(docs), learned, ("lang_pred", "score"), size)


def annotate(docs: DataFrame, learned: DataFrame, names: tuple[str, str], size: int = PROFILE) -> DataFrame:
    """All columns of ``docs``, and under ``names`` the language and score that ``predict`` gives."""
    # At most ``size`` rows for each language.
    table = learned.toPandas()
    langs = sorted(table["lang"].unique())
    keys = np.sort(table["key"].unique()).astype(np.int64)
    ranks = np.full((len(langs), len(keys)), -1, np.int32)
    for i, lang in enumerate(langs):
        own = table[table["lang"] == lang]
        ranks[i, np.searchsorted(keys, own["key"].to_numpy())] = own["rank"].to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, items in text_batches(batches):
            n = len(items)
            groups, grams, counts = count_ngrams([t or "" for t in items], np.arange(n))
            pred, score = np.full(n, -1), np.zeros(n)
            if len(grams) and langs:
                # Text, then falling count, then key: one sort of whole numbers.
                order = np.lexsort((-counts, groups))
                groups, grams = groups[order], grams[order]
                begins = np.searchsorted(groups, np.arange(n))
                place = np.arange(len(groups)) - begins[groups]
                top = place < size
                groups, grams, place = groups[top], grams[top], place[top]
                at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
                known = keys[at] == grams
                distance = np.empty((len(langs), n))
                for i in range(len(langs)):
                    own = ranks[i, at]
                    apart = np.where(known & (own >= 0), np.abs(own - place), size)
                    distance[i] = np.bincount(groups, weights=apart, minlength=n)
                used = np.bincount(groups, minlength=n)
                best = distance.argmin(axis=0)
                some = used > 0
                pred[some] = best[some]
                score[some] = 1 - distance[best, np.arange(n)][some] / (used[some] * size)
            found = np.array([*langs, UNKNOWN], dtype=object)[pred]
            columns = [*rows.columns, pa.array(found, pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, [*rows.schema.names, *names])

    schema = StructType([*docs.schema.fields, StructField(names[0], StringType()), StructField(names[1], DoubleType())])
    return docs.mapInArrow(run, schema)
