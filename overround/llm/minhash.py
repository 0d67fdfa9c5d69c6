"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct runs of five words. Its sketch has ``BINS`` coordinates, filled in rounds: in
round i < BINS each element falls into a hashed bin with a hashed value, and a bin keeps the smallest value of the
first round that reached it; in the BINS rounds after, round BINS + i puts every element into bin i, so every
coordinate is filled in the end, and mostly within the first few rounds. Two sets agree in a coordinate with
probability equal to their similarity, with concentration bounds as for independent hash functions, for about
BINS * ln(BINS) hashed placements instead of BINS for each element.

At a bound of 0.85 eight coordinates form a band, 40 bands cover the sketch: sets of similarity 0.85 miss each other in
all bands with probability (1 - 0.85^8)^40 = 3e-6, sets of similarity 0.3 meet in 0.3 % of all cases. At lower bounds
bands are narrower and more, so that sets at the bound miss each other with probability ``MISSES`` at most: at 0.8 there
are 45 bands of seven, (1 - 0.8^7)^45 = 2.5e-5.

Groups of any size are joined without listing their pairs: equal sets are one class; in each bucket the classes are
verified against the bucket's smallest class; only classes that this leaves in different components of one bucket are
then compared with each other, and of those only pairs that share one of their rarest shingles early enough in the order
of rarity for the sets to be linked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from overround.llm.components import connected_components
from overround.llm.shared import gram_hashes, joined_words, mix, span_hashes, text_slices, written

WORDS, BINS, ROWS = 5, 320, 8
#: Largest probability that two sets whose similarity is just the bound share no band.
MISSES = 5e-5
SEEDS = np.random.default_rng(7).integers(0, 2**64, 2 * BINS, dtype=np.uint64)
_BAND_FACTORS = np.random.default_rng(8).integers(0, 2**63, ROWS, dtype=np.uint64) | np.uint64(1)
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(55)
_LOW = np.uint64((1 << 45) - 1)
_KEY = np.uint64((1 << 55) - 1)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; a text of one to four words has one shingle."""
    data, starts, ends, counts = joined_words(texts, lower=True)
    words = span_hashes(data, starts, ends)
    grams = gram_hashes(words, WORDS)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(grams[at : at + n - WORDS + 1]))
        elif n:
            out.append(gram_hashes(words[at : at + n], n) ^ np.uint64(n))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def sketch(elements: np.ndarray) -> np.ndarray:
    """The BINS coordinates of a set that isn't empty."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    empty = np.arange(BINS)
    at, step = 0, max(1, math.ceil(BINS * (math.log(BINS) + 3) / len(elements)))
    while len(empty):
        rounds = np.arange(at, min(at + step, 2 * BINS), dtype=np.uint64)
        hashes = mix(elements[None, :] ^ SEEDS[rounds.astype(np.int64)][:, None])
        bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        forced = rounds >= BINS
        if forced.any():
            bins[forced] = (rounds[forced] - np.uint64(BINS))[:, None]
        keys = ((bins << np.uint64(55)) | (rounds << np.uint64(45))[:, None] | (hashes & _LOW)).ravel()
        keys.sort()
        first = np.searchsorted(keys, _EDGES[empty])
        found = keys[np.minimum(first, len(keys) - 1)]
        hit = (first < len(keys)) & ((found >> np.uint64(55)) == empty.astype(np.uint64))
        out[empty[hit]] = found[hit] & _KEY
        empty, at = empty[~hit], at + step
    return out


def band_rows(percent: int) -> int:
    """Coordinates in a band: the most, up to ROWS, with which sets at the bound miss each other in MISSES of all cases."""
    fits = (r for r in range(ROWS, 1, -1) if (1 - (percent / 100) ** r) ** (BINS // r) <= MISSES)
    return next(fits, 1)


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    bands = coordinates[: len(coordinates) // rows * rows].reshape(-1, rows)
    return mix((bands * _BAND_FACTORS[:rows]).sum(axis=1, dtype=np.uint64))


def _sketch_rows(rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sizes, fingerprints and band keys of the sets, with ``rows`` coordinates in a band."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 1):
            sets = shingle_sets(batch.column(1).to_pylist())
            sizes = np.array([len(s) for s in sets], np.int64)
            prints = np.zeros((2, len(sets)), np.uint64)
            keys = []
            for i, s in enumerate(sets):
                if len(s):
                    prints[0, i], prints[1, i] = mix(s ^ SEEDS[0]).sum(), mix(s ^ SEEDS[1]).sum()
                    keys.append(band_keys(sketch(s), rows))
            offsets = np.concatenate([[0], np.cumsum((sizes > 0) * (BINS // rows))]).astype(np.int32)
            flat = np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), *(pa.array(p.view(np.int64)) for p in prints),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "n", "f1", "f2", "bands"])

    return sketches


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, 1):
        sets = shingle_sets(batch.column(1).to_pylist())
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["node", "elements"])


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of ``documents``.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets, confirmed on the full
    sets (of 64-bit shingle hashes). ``component_id`` is the smallest id that links reach; ``kept`` marks the
    document of that id. Null and blank texts have an empty set: no links, kept. Rows that share an id are one
    document, linked with whatever any of its rows is linked with. Rows with a null id belong to no component
    (null) and are kept. Very long texts are sketched whole. Other columns are ignored, whatever their names; an
    empty table gives an empty result.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_sketch_rows(band_rows(percent)), "id long, n long, f1 long, f2 long, bands array<long>"), "sketches")
    full = rows.where("n > 0 and id is not null")

    # Equal sets: one class, named by its smallest document.
    classes = full.groupBy("f1", "f2").agg(F.min("id").alias("node"))
    members = written(full.join(classes, ["f1", "f2"]).select("id", "node", "n", F.when(
        F.col("id") == F.col("node"), F.col("bands")).alias("bands")), "classes")
    spans = members.groupBy("id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    shared_ids = members.select("id", "node").join(spans.select("id", "low"), "id").where("node != low").select(
        F.col("node").alias("a"), F.col("low").alias("b"))

    # Candidates: every class against the smallest class of each of its buckets.
    buckets = members.where("bands is not null").select("node", "n", F.posexplode("bands").alias("band", "key"))
    leads = buckets.groupBy("band", "key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where(
        "lead < last").drop("last")
    crowded = written(buckets.join(leads, ["band", "key"]), "buckets")
    stars = crowded.where("node != lead").select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct()
    wanted = crowded.select("node").distinct()
    sets = written(texts.join(wanted, F.col("id") == F.col("node"), "left_semi").mapInArrow(
        _set_rows, "node long, elements array<long>"), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full sets meet the bound; ``linked`` says so."""
        left = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
        right = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("ea", "eb"))
        union = F.size("ea") + F.size("eb") - common
        return both.select("a", "b", (100 * common >= percent * union).alias("linked")).groupBy("a", "b").agg(
            F.max("linked").alias("linked"))

    tried = written(verified(stars), "verified")
    links = tried.where("linked").select("a", "b").union(shared_ids)
    found = connected_components(links, "a", "b")

    # What the stars left apart: classes of one bucket that lie in different components. Of n shingles a link needs
    # at least percent % in common, so two linked sets share one among the n - ceil(n * percent / 100) + 1 rarest of
    # each, in one order of all shingles; the many copies of a text that differ too much to be linked don't meet there.
    placed = crowded.join(found, "node", "left").select(
        "band", "key", "node", "n", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("band", "key")
    apart = written(placed.join(mixed, ["band", "key"]).select("node", "component").distinct(), "apart")
    held = written(sets.join(apart, "node").select(
        "node", "component", F.size("elements").alias("n"), F.explode("elements").alias("shingle")), "held")
    counted = held.join(held.groupBy("shingle").agg(F.count("*").alias("df")), "shingle")
    rarest = counted.groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("order"))
    prefix = written(rarest.select("node", "component", "n", F.posexplode(F.slice(
        "order", 1, (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))).alias("place", "rare")).where(
        "rare.df > 1").select("node", "component", "n", "place", F.col("rare.shingle").alias("shingle")), "prefix")
    left, right = (prefix.select("shingle", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("component").alias(f"c{x}"),
                                 F.col("place").alias(f"p{x}")) for x in ("b", "a"))
    # Behind the first shared one, only what follows in both orders can be common too.
    cross = left.join(right, "shingle").where(
        f"b < a and ca != cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)").where(
        f"(100 + {percent}) * (1 + least(na - 1 - pa, nb - 1 - pb)) >= {percent} * (na + nb)").select("a", "b").distinct()
    cross = written(cross.join(tried, ["a", "b"], "left_anti"), "cross")
    late = written(verified(cross).where("linked").select("a", "b"), "late")
    if not late.isEmpty():
        found = connected_components(links.union(late), "a", "b")

    named = members.groupBy("id").agg(F.min("node").alias("node")).join(found, "node", "left").select(
        F.col("id").alias("known"), F.coalesce("component", "node").alias("component"))
    out = rows.select("id", "n").join(named, F.col("id") == F.col("known"), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
