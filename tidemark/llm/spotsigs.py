"""Document fingerprints by SpotSigs.

A signature begins at an anchor, one of the most common words, and is the chain
of the next content words (words that are no anchors) after it, taken at a
fixed distance from one another. A text's fingerprint is its set of signatures.
Common words stand in running text and hardly in lists and menus, so that the
signatures describe the prose. Sets are compared by Jaccard similarity; sets
whose lengths differ too much for a threshold lie in partitions that are never
compared, and counting stops where the rest cannot reach it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.data import stored
from tidemark.llm.textbuf import ALNUM, PIECE_BYTES, Words, draws, find_words, mix, pieces, text_bytes

# Very common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or she that the this to was were will with "
    "das dem den der des die ein eine er es ist mit nicht oder sich sie und von war zu "
    "au ce dans des du elle en est et il la le les mais ou par pas pour que qui sur un une "
    "al como con de del el ella las lo los no para pero por se su una y"
).split()
#: Content words in a chain, and how far apart they are taken.
CHAIN, DISTANCE = 3, 1
#: A text's set must be at least this similar for a pair to be listed.
THRESHOLD = 0.6


def _anchor_hashes(anchors: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array(anchors, pa.string()))
    return np.unique(find_words(data, offsets, ALNUM).hash)


_MULTIPLY = draws(CHAIN, 401) | np.uint64(1)


def signatures(words: Words, anchors: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct signatures of each text.

    In a text where no anchor has a whole chain, each word is taken for one; of
    fewer words than a chain all are one signature. Without words there is none.
    """
    at = np.minimum(np.searchsorted(anchors, words.hash), max(len(anchors) - 1, 0))
    is_anchor = anchors[at] == words.hash if len(anchors) else np.zeros(len(words.hash), bool)
    content = np.flatnonzero(~is_anchor)
    spots = np.flatnonzero(is_anchor)
    begin = np.searchsorted(content, spots)  # the first content word behind each anchor
    reach = (CHAIN - 1) * DISTANCE
    whole = begin + reach < len(content)
    spots, begin = spots[whole], begin[whole]
    same = words.doc[content[begin + reach]] == words.doc[spots]
    spots, begin = spots[same], begin[same]
    value = words.hash[spots]
    for k in range(CHAIN):
        value = value + words.hash[content[begin + k * DISTANCE]] * _MULTIPLY[k]
    value = mix(value)
    texts = len(words.first) - 1
    bounds = np.searchsorted(words.doc[spots], np.arange(texts + 1))
    out = []
    for i in range(texts):
        own = value[bounds[i] : bounds[i + 1]]
        a, b = words.first[i], words.first[i + 1]
        if not len(own) and b > a:
            n = max(b - a - CHAIN + 1, 1)
            own = np.zeros(n, np.uint64)
            for k in range(min(CHAIN, b - a)):
                own = own + words.hash[a + k : a + k + n] * _MULTIPLY[k]
            own = mix(own)
        out.append(np.unique(own))
    return out


def fingerprint(signature_set: np.ndarray) -> str:
    """Length of the set and a digest of it; equal for equal sets."""
    return f"{len(signature_set)}:{hashlib.sha256(signature_set.tobytes()).hexdigest()[:32]}"


def likeness(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard similarity; 0 if below the threshold, which is often seen early.

    Two empty sets are alike in full, an empty one and another not at all.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return 0.0
    if threshold:  # look at the smaller values first: too few common ones settle it
        middle = max(a[len(a) // 2], b[len(b) // 2])
        a_head, b_head = np.searchsorted(a, middle), np.searchsorted(b, middle)
        common = len(np.intersect1d(a[:a_head], b[:b_head], assume_unique=True))
        most = common + min(len(a) - a_head, len(b) - b_head)
        if most < threshold * (len(a) + len(b) - most):
            return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    similarity = common / (len(a) + len(b) - common)
    return similarity if similarity >= threshold else 0.0


def fingerprints(docs: DataFrame, anchors: list[str] = ANCHORS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``fingerprint``, ``n_signatures`` and ``signatures`` (sorted 64-bit values) of whole texts.

    Null and empty texts have no signature. One row per input row; other
    columns are not read.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    known = _anchor_hashes(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            data, offsets = text_bytes(piece.column("text"))
            sets = signatures(find_words(data, offsets, ALNUM), known)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("id"),
                    pa.array([fingerprint(s) for s in sets]),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "fingerprint", "n_signatures", "signatures"],
            )

    out = rows.mapInArrow(run, f"id {kind}, fingerprint string, n_signatures long, signatures array<long>")
    return out.withColumnRenamed("id", id_column)


def ordered_parts(docs: DataFrame, parts: int) -> DataFrame:
    """``docs(id, text)`` in ranges of ids, with the next range's first row at the end of each.

    Adds ``part`` and ``borrowed``. The bounds are quantiles of the ids, a few
    numbers; all rows of one id lie in one range. Rows without an id come last,
    in a range of their own. The last range borrows the first row of all.
    """
    known = docs.filter("id IS NOT NULL")
    shares = [k / parts for k in range(1, parts)]
    bounds = sorted(set(known.agg(F.percentile_approx("id", shares, 10_000)).first()[0] or [])) if shares else []
    part = F.lit(0)
    for bound in bounds:
        part = part + (F.col("id") > bound).cast("int")
    last = len(bounds)
    placed = docs.withColumn("part", F.when(F.col("id").isNull(), last + 1).otherwise(part))
    firsts = placed.groupBy("part").agg(F.min("id").alias("first")).filter("first IS NOT NULL")
    order = sorted((r["part"], r["first"]) for r in firsts.collect())  # a row for each range
    if placed.filter("id IS NULL").limit(1).count():
        order.append((last + 1, None))
    borrows = {}
    for k, (p, _) in enumerate(order):
        borrows.setdefault(order[(k + 1) % len(order)], []).append(p)
    own = placed.withColumn("borrowed", F.lit(False))
    if not order:
        return own
    # The smallest text of the first id; a few rows, one for each range.
    first_ids = [i for _, i in order if i is not None]
    wanted = placed.filter(F.col("id").isin(first_ids) if first_ids else F.lit(False))
    if any(i is None for _, i in order):
        wanted = wanted.unionAll(placed.filter("id IS NULL"))
    wanted = wanted.groupBy("part", "id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    takers = F.create_map(*(x for (p, _), takes in borrows.items() for x in (F.lit(p), F.array(*map(F.lit, takes)))))
    lent = wanted.select("id", "text", F.explode(takers[F.col("part")]).alias("part"), F.lit(True).alias("borrowed"))
    return own.unionByName(lent)


def compare_edited(
    docs: DataFrame, anchors: list[str] = ANCHORS, id_column: str = "doc_id", text_column: str = "text", parts: int | None = None
) -> DataFrame:
    """Fingerprints of whole texts, of their edited texts, and how alike they are.

    The edited text has the last quarter of the characters replaced by as many
    first characters of the next document by id (after the last: of the first).
    Returns ``id_column``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``. Null texts count
    as empty. Rows of one id come in the order of their texts; rows without an
    id come last, ordered by text. A document alone is its own next.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    known = _anchor_hashes(anchors)
    parts = parts or max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = ordered_parts(rows, parts).withColumn("text", F.coalesce("text", F.lit("")))
    # By range: hashes of so few numbers would put several ranges into one task and none into others.
    placed = placed.repartitionByRange(parts + 1, "part").sortWithinPartitions("part", "borrowed", F.col("id").asc_nulls_last(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None  # the last row seen: part, id, text, its signatures
        for batch in pieces(batches, limit=PIECE_BYTES // 2):
            part = batch.column("part").to_pylist()
            ids = batch.column("id").to_pylist()
            texts = batch.column("text").to_pylist()
            sets = _sets(batch.column("text"), known)
            if carried is not None:
                part, ids, texts, sets = [carried[0], *part], [carried[1], *ids], [carried[2], *texts], [carried[3], *sets]
            yield _compared(part, ids, texts, sets, known, batch.column("id").type)
            carried = (part[-1], ids[-1], texts[-1], sets[-1])

    out = placed.mapInArrow(
        run,
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
    return out.withColumnRenamed("id", id_column)


def _sets(column: pa.Array, anchors: np.ndarray) -> list[np.ndarray]:
    data, offsets = text_bytes(column)
    return signatures(find_words(data, offsets, ALNUM), anchors)


def _compared(part, ids, texts, sets, anchors, id_type) -> pa.RecordBatch:
    """A row for each text whose next one in the same part is known.

    The last row of a part is borrowed, and only serves as a next one.
    """
    at = [k for k in range(len(texts) - 1) if part[k] == part[k + 1]]
    edited = []
    for k in at:
        n = len(texts[k]) // 4
        edited.append(texts[k][: len(texts[k]) - n] + texts[k + 1][:n])
    edited_sets = _sets(pa.array(edited, pa.string()), anchors)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids[k] for k in at], id_type),
            pa.array([len(texts[k]) for k in at], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
            pa.array([fingerprint(sets[k]) for k in at], pa.string()),
            pa.array([fingerprint(s) for s in edited_sets], pa.string()),
            pa.array([likeness(sets[k], s) for k, s in zip(at, edited_sets)], pa.float64()),
            pa.array([likeness(sets[k], sets[k + 1]) for k in at], pa.float64()),
        ],
        names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def similar_pairs(docs: DataFrame, anchors: list[str] = ANCHORS, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of distinct signature sets with a likeness of at least ``threshold``.

    ``docs(doc_id, text)``; returns ``a`` and ``b``, the smallest ids that have
    each set (a < b), and ``likeness``. Sets are partitioned by length in
    steps of ``threshold``; a set meets those of its own partition and the next.
    Within one, sets only meet that share one of so many of their least
    signatures, rarest first, that pairs without any stay below the threshold.
    """
    prints = fingerprints(docs, anchors).filter("doc_id IS NOT NULL AND n_signatures > 0")
    sets = stored(
        prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id"), F.min("signatures").alias("signatures"))
    )
    band = F.floor(F.log(F.size("signatures")) / -np.log(threshold)).cast("int")
    rows = sets.select("doc_id", band.alias("band"), F.size("signatures").alias("n"), F.explode("signatures").alias("s"))
    frequency = rows.groupBy("s").agg(F.count("*").alias("df")).filter("df > 1")
    ranked = rows.join(frequency, "s").groupBy("doc_id", "band", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "s"))).alias("shared")
    )
    # Signatures of one set only cannot be common and come first in the order.
    length = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    taken = F.greatest(length - (F.col("n") - F.size("shared")), F.lit(0)).cast("int")
    prefix = ranked.select("doc_id", "band", "n", F.explode(F.slice("shared", 1, taken)).alias("x"))
    prefix = prefix.select("doc_id", "band", "n", F.col("x.s").alias("s"))
    meets = prefix.withColumn("slot", F.explode(F.array("band", F.col("band") + 1)))
    a = meets.select("s", "slot", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("band").alias("band_a"))
    b = meets.select("s", "slot", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("band").alias("band_b"))
    near = (F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb")) & (F.col("a") < F.col("b"))
    pairs = a.join(b, ["s", "slot"]).filter(near & (F.greatest("band_a", "band_b") == F.col("slot"))).select("a", "b").distinct()
    left = sets.select(F.col("doc_id").alias("a"), F.col("signatures").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("signatures").alias("sb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [
                likeness(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64), threshold)
                for x, y in zip(batch.column("sa"), batch.column("sb"))
            ]
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike)], names=["a", "b", "likeness"])
            yield out.filter(pa.array([v > 0 for v in alike], pa.bool_()))

    kind = sets.schema["doc_id"].dataType.simpleString()
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(run, f"a {kind}, b {kind}, likeness double")
