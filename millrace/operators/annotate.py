"""Finding entity names in documents by whole tokens."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from millrace.lineage import materialize

_TOKEN = r"(\p{L}+|\p{N}+)"

_GRAMS = T.ArrayType(T.StructType([
    T.StructField("gram", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()), T.StructField("text", T.StringType()),
]))

# The filter that tasks get has at least 2^20 and at most 2^26 bits (8 MB), whatever the number of names.
_BITS_MIN, _BITS_MAX = 20, 26
# Texts are searched together until they hold this many characters; a longer text is searched whole.
_CHUNK = 1 << 18
# Of a batch of texts so many at a time become Python objects.
_ROWS = 256
_NONE, _LETTER, _NUMBER = 0, 1, 2
_LEFT, _RIGHT, _SIZE, _PREFIX = (np.uint64(c) for c in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _RIGHT
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point its kind and the folded code point that stands for it in hashes."""
    kinds, folded = np.zeros(0x110000, np.uint8), np.zeros(0x110000, np.uint32)
    for first in range(0, 0x110000, 1 << 14):
        texts = ["\ufffd" if 0xD800 <= c < 0xE000 else chr(c) for c in range(first, first + (1 << 14))]
        every = "".join(texts)
        for kind, pattern in (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"):
            for m in regex.finditer(pattern, every):
                kinds[first + m.start():first + m.end()] = kind
        folded[first:first + (1 << 14)] = [ord(t.lower()[0]) for t in texts]
    folded[ord("\u03c2")] = ord("\u03c3")  # how a sigma is folded depends on its place in the token
    return kinds, folded[folded]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _tokens(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, begin, end)`` of every run of letters or of numbers; the hash is that of the folded run."""
    kinds, folded = _characters()
    kind = np.zeros(len(codes) + 2, np.uint8)
    kind[1:-1] = kinds[codes]
    change = kind[1:] != kind[:-1]
    begin = np.flatnonzero(change[:-1] & (kind[1:-1] != _NONE))
    end = np.flatnonzero(change[1:] & (kind[1:-1] != _NONE)) + 1
    if not len(begin):
        return np.zeros(0, np.uint64), begin, end
    inside = np.flatnonzero(kind[1:-1] != _NONE)
    first = np.cumsum(end - begin) - (end - begin)
    place = (np.arange(len(inside)) - np.repeat(first, end - begin)).astype(np.uint64)
    values = _mixed(folded[codes[inside]].astype(np.uint64) * _LEFT + place * _SIZE)
    return np.add.reduceat(values, first), begin, end


def _level(n: int) -> int:
    """The largest power of two (its exponent) not above ``n``."""
    return n.bit_length() - 1


def _levels(tokens: np.ndarray, most: int) -> list[np.ndarray]:
    """Hashes of the runs of 1, 2, 4, ... tokens at every position, up to ``most`` tokens."""
    levels = [_mixed(tokens * _LEFT)]
    while len(levels) <= _level(most) and len(levels[-1]) > 1 << (len(levels) - 1):
        half = 1 << (len(levels) - 1)
        levels.append(_mixed(levels[-1][:-half] * _LEFT + levels[-1][half:]))
    return levels


def _run_hash(levels: list[np.ndarray], at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` tokens at ``at``: two overlapping runs of a power of two cover each."""
    k = _level(n)
    return _mixed(levels[k][at] * _LEFT + levels[k][at + (n - (1 << k))] + np.array([n], np.uint64) * _SIZE)


def _prefix_hash(levels: list[np.ndarray], at: np.ndarray, k: int) -> np.ndarray:
    return _mixed(levels[k][at] ^ _PREFIX)


def _name_hashes(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(names, hashes)``: for each name (tokens joined by a blank), by its number, those of its prefixes
    of 1, 2, 4, ... tokens and of the whole."""
    if not names:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes = _codes("\n".join(names))
    # Folding may add marks to a letter; they are no part of a token in a text.
    codes = codes[(_characters()[0][codes] != _NONE) | (codes == ord(" ")) | (codes == ord("\n"))]
    tokens, begin, _ = _tokens(codes)
    lines = np.flatnonzero(codes == ord("\n"))
    first = np.searchsorted(begin, np.concatenate([[0], lines]))
    sizes = np.diff(np.append(first, len(tokens)))
    levels = _levels(tokens, int(sizes.max()))
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for k in range(_level(int(sizes.max())) + 1):
        own = np.flatnonzero(sizes >= 1 << k)
        owners.append(own)
        hashes.append(_prefix_hash(levels, first[own], k))
    for n in np.unique(sizes[sizes > 0]).tolist():
        own = np.flatnonzero(sizes == n)
        owners.append(own)
        hashes.append(_run_hash(levels, first[own], n))
    return np.concatenate(owners), np.concatenate(hashes)


def name_slots(bits: int):
    """UDF: the slots of the filter of ``2 ** bits`` bits that a name (tokens joined by a blank) sets."""
    def slots(names: pa.Array) -> pa.Array:
        owners, hashes = _name_hashes(names.to_pylist())
        offsets = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(names)))])
        values = (hashes[np.argsort(owners, kind="stable")] >> np.uint64(64 - bits)).astype(np.int64)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    slots.__annotations__ = {"names": pa.Array, "return": pa.Array}
    return F.arrow_udf(slots, T.ArrayType(T.LongType()))


def _name_filter(grams: DataFrame, bits: int) -> np.ndarray:
    """The slots of all names as bits; Spark fills it in pieces of 32768 bits."""
    slots = grams.select(F.explode(name_slots(bits)("gram")).alias("slot"))
    number = F.col("slot") + 1  # bitmap positions count from 1
    pieces = slots.groupBy(F.bitmap_bucket_number(number).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))
    filled = np.zeros((1 << bits) // 8, np.uint8)
    for row in pieces.collect():
        piece = np.frombuffer(bytes(row["bitmap"]), np.uint8)
        filled[(row["piece"] - 1) * 4096:][:4096] = piece
    return filled


def _places(tokens: np.ndarray, ends: np.ndarray, lengths: Sequence[int], filled: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """``(positions, n)`` of runs that pass the filter; ``ends`` is the end of each token's text.

    As in a trie, a position is followed to longer runs only while its prefix is one of a name.
    """
    shift = np.uint64(64 - (len(filled) * 8).bit_length() + 1)

    def passing(at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> shift).astype(np.int64)
        return at[(filled[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1]

    levels = _levels(tokens, max(lengths))
    alive, reached, found = np.arange(len(tokens)), -1, []
    for n in sorted(lengths):
        k = _level(n)
        if k > reached:
            alive = alive[alive + (1 << k) <= ends[alive]]
            if not len(alive):
                break
            alive, reached = passing(alive, _prefix_hash(levels, alive, k)), k
        at = alive[alive + n <= ends[alive]]
        at = passing(at, _run_hash(levels, at, n)) if len(at) else at
        if len(at):
            found.append((at, n))
    return found


def _chunks(texts: list[str | None], size: int) -> Iterator[tuple[list[int], list[str]]]:
    """``(text numbers, texts)`` of consecutive texts of about ``size`` characters."""
    numbers, held, total = [], [], 0
    for number, text in enumerate(texts):
        if not text:
            continue
        numbers.append(number)
        held.append(text)
        total += len(text)
        if total >= size:
            yield numbers, held
            numbers, held, total = [], [], 0
    if held:
        yield numbers, held


def find_runs(texts: list[str | None], lengths: Sequence[int], filled: np.ndarray,
              size: int = _CHUNK) -> dict[int, list[tuple[int, list[tuple[int, int]]]]]:
    """Per text number ``(token, spans of the run's tokens)`` of runs that the filter lets pass; some may be no name."""
    found: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    for numbers, held in _chunks(texts, size):
        hashes, begin, end = _tokens(_codes("\n".join(held)))
        if not len(hashes):
            continue
        offsets = np.cumsum([0] + [len(t) + 1 for t in held])
        starts = np.searchsorted(begin, offsets)
        ends = np.repeat(starts[1:], np.diff(starts))
        for at, n in _places(hashes, ends, lengths, filled):
            for i, k in zip(at.tolist(), (np.searchsorted(starts, at, "right") - 1).tolist()):
                spans = zip((begin[i:i + n] - offsets[k]).tolist(), (end[i:i + n] - offsets[k]).tolist())
                found.setdefault(numbers[k], []).append((i - int(starts[k]), list(spans)))
    return found


def token_runs(lengths: Sequence[int], filled: np.ndarray):
    """UDF: runs of ``lengths`` tokens in a text, folded, with offsets and the text they cover.

    Only runs that pass the filter of all names leave it. Work is linear in the text: hashes of runs of
    any length come from those of powers of two, and longer ones are tried only behind prefixes of names.

    Spark has no expression that returns match positions in linear time.
    """
    def some(texts: pa.Array) -> pa.Array:
        listed = texts.to_pylist()
        found = find_runs(listed, lengths, filled)
        grams, starts, stops, covered, offsets = [], [], [], [], [0]
        for number, text in enumerate(listed):
            for _, spans in found.get(number, ()):
                a, b = spans[0][0], spans[-1][1]
                grams.append(" ".join([text[c:d].lower() for c, d in spans]))
                starts.append(a)
                stops.append(b)
                covered.append(text[a:b])
            offsets.append(len(grams))
        cells = pa.StructArray.from_arrays(
            [pa.array(grams, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32()),
             pa.array(covered, pa.string())], ["gram", "start", "stop", "text"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)

    def runs(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([some(texts.slice(at, _ROWS)) for at in range(0, max(len(texts), 1), _ROWS)])

    runs.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(runs, _GRAMS)


def name_tokens(name: Column) -> Column:
    """Tokens of a name, cut first and folded one by one, as those of the texts are."""
    return F.transform(F.regexp_extract_all(name, F.lit(_TOKEN), F.lit(1)), F.lower)


def entity_names(entities: DataFrame, search_field: str, min_tokens: int = 2) -> DataFrame:
    """Distinct searchable names ``(name_key, n_tokens)``: at least ``min_tokens`` tokens, and one."""
    tokens = name_tokens(F.col(search_field))
    return entities.select(F.array_join(tokens, " ").alias("name_key"), F.size(tokens).alias("n_tokens")) \
        .where(F.col("n_tokens") >= max(min_tokens, 1)).distinct()


def _grams(names: DataFrame, partial: bool, min_tokens: int) -> DataFrame:
    """Searched token runs ``(gram, n, name_key, confidence)``.

    A full name finds itself. With ``partial`` a shorter run counts too, when it
    belongs to one name only.
    """
    full = names.select(F.col("name_key").alias("gram"), F.col("n_tokens").alias("n"), "name_key",
                        F.lit(1.0).alias("confidence"))
    if not partial:
        return full
    tokens = F.split("name_key", " ")
    sizes = F.sequence(F.lit(min_tokens), F.col("n_tokens") - 1)
    runs = names.where(F.col("n_tokens") > min_tokens).select("name_key", "n_tokens", tokens.alias("t"), F.explode(sizes).alias("n"))
    runs = runs.select("name_key", "n_tokens", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("n_tokens") - F.col("n") + 1),
        lambda i: F.array_join(F.slice("t", i, F.col("n")), " "))).alias("gram")).distinct()
    single = runs.groupBy("gram", "n").agg(
        F.min("name_key").alias("name_key"), F.max("name_key").alias("_other"), F.min("n_tokens").alias("n_tokens")
    ).where(F.col("name_key") == F.col("_other"))
    parts = single.join(full.select("gram"), "gram", "left_anti").select(
        "gram", "n", "name_key", (F.col("n") / F.col("n_tokens")).alias("confidence")
    )
    return full.unionByName(parts)


def detect_annotations(documents: DataFrame, entities: DataFrame, search_field: str, doc_id: str = "doc_id",
                       text: str = "text", partial_match: bool = False, min_tokens: int = 2) -> DataFrame:
    """``(doc_id, start, stop, text, name_key, confidence)`` of every place a name occurs.

    One pass over the texts finds the runs that pass a filter of all names, and an equi
    join on the run itself settles which are names. A partial hit inside a longer hit
    of the same name is dropped. Names shared by many entities are searched once (see
    :func:`annotation_entities`).
    """
    grams = _grams(entity_names(entities, search_field, min_tokens), partial_match, min_tokens)
    if partial_match:
        grams = materialize(grams, "names")  # read three times
    counts = {r["n"]: r["count"] for r in grams.groupBy("n").count().collect()}
    lengths = sorted(counts) or [max(min_tokens, 1)]
    # A name sets a bit for each power of two in its length and one for the whole: about one bit in 16 is set.
    wanted = 16 * sum(c * (_level(n) + 2) for n, c in counts.items())
    filled = _name_filter(grams, min(max(wanted.bit_length(), _BITS_MIN), _BITS_MAX))
    # Only the runs leave the scan: the text itself is neither exploded nor shuffled.
    runs = documents.select(F.col(doc_id).alias("doc_id"), F.explode(token_runs(lengths, filled)(F.col(text))).alias("r")).select(
        "doc_id", "r.gram", "r.start", "r.stop", "r.text"
    )
    hits = runs.join(grams.select("gram", "name_key", "confidence"), "gram")
    if partial_match:
        inside = W.partitionBy("doc_id", "name_key").orderBy("start", F.desc("stop")) \
            .rowsBetween(W.unboundedPreceding, -1)
        hits = hits.withColumn("_reach", F.max("stop").over(inside)).where(
            F.col("_reach").isNull() | (F.col("stop") > F.col("_reach"))
        )
    return hits.select("doc_id", "start", "stop", "text", "name_key", "confidence")


def annotation_entities(annotations: DataFrame, entities: DataFrame, search_field: str) -> DataFrame:
    """One row per annotation and entity that carries the name."""
    keyed = entities.withColumn("name_key", F.array_join(name_tokens(F.col(search_field)), " "))
    return annotations.join(keyed, "name_key")
