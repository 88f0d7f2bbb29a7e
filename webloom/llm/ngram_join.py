"""Similarity join of documents on word n-grams (Jaccard), by a token-group matrix.

Similar documents are put into groups, the union of each group's tokens is stored as a matrix of tokens and
groups, a query's overlap with each group is bounded by the tokens it shares with the union, and only groups
whose bound reaches the threshold are opened and compared document by document.

Which documents need one matrix is settled first, exactly and without comparing pairs. The tokens of a document
of a size band are dealt into D + 1 or more parts, D being the most tokens in which two linked documents of that
band can differ; so linked documents agree on a whole part. Two documents that agree on a part may still be far
apart, and in a large corpus such chance meetings would chain most documents together. So each has a parity sketch:
the bits in which two sketches differ never outnumber the tokens in which their sets differ, and a pair with more
such bits than a link allows is surely not linked. Documents that agree on a part and may be linked by their sketches
get into one family (connected components): all are compared with the least document of their part, and only those
that are in different components after that with one another. Families are laid
out in order over range partitions of bounded size; each partition builds its own matrices. A family that
runs over several partitions is finished by comparing partition with partition: first one document for each
component found so far, then, if components are left apart, all documents of the partitions concerned.

Equal sets are collapsed to one representative beforehand. Documents in one component already are not compared
again. Sets are of 64-bit hashes, classes of equal sets of 128-bit sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, materialize, release_memory, sifted
from webloom.llm.components import connected_components

WORDS = 5
PERCENT = 80
#: Documents in a group of the matrix.
GROUP = 32
#: Bytes of token sets in a partition of families.
PARTITION_BYTES = 16 << 20
BAND_RATIO = 1.5
#: Words of 64 bits of the longest parity sketch.
SKETCH_WORDS = 1 << 11
#: Documents of one signature that are compared in one group, with themselves or as many others.
CELL = 1 << 12

_U = np.uint64
#: Odd 64-bit constants of well-known mixing functions.
_C1, _C2, _C3 = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53), _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit affects every output bit."""
    x = (x ^ (x >> _U(33))) * _C1
    x = (x ^ (x >> _U(33))) * _C2
    return x ^ (x >> _U(33))


def token_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of a text (A-Z lower-cased, split at ASCII white space); of
    fewer words, of the whole sequence; of none, empty."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = out * _C3 + h[j : len(h) - width + 1 + j]
    return np.unique(mix(out))


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    return tuple(int(mix(tokens ^ c).sum(dtype=np.uint64).view(np.int64)) for c in (_C1, _C2))


class Bands:
    """Size bands and the number of parts that a band's documents are dealt into."""

    def __init__(self, percent: int) -> None:
        if not 75 <= percent <= 100:
            raise ValueError("percent must be from 75 to 100")
        self.percent, self.edges, self._parts = percent, [1, 2], {}

    def of(self, n: int) -> list[int]:
        """The band of a size, and the next one if a linked document can be in it."""
        while self.edges[-2] <= n * 100 // self.percent + 1:
            self.edges.append(max(self.edges[-1] + 1, int(self.edges[-1] * BAND_RATIO)))
        b = int(np.searchsorted(self.edges, n, side="right")) - 1
        return [b, b + 1] if self.edges[b + 1] * self.percent <= 100 * n else [b]

    def parts(self, band: int) -> tuple[int, int]:
        """``(parts, differing)``: linked documents of a band differ in at most ``differing`` tokens. There are so
        many more parts that a document's empty parts hardly ever use them up."""
        if band not in self._parts:
            low, high = self.edges[band] * self.percent // 100, self.edges[band + 1] - 1
            d = (100 - self.percent) * 2 * high // (100 + self.percent)
            spare = 0
            for _ in range(8):
                empty = (d + 1 + spare) * math.exp(-max(low, 1) / (d + 1 + spare))
                spare = min(d, math.ceil(empty + 2 * math.sqrt(empty)))
            self._parts[band] = (d + 1 + spare, d)
        return self._parts[band]


def signatures(tokens: np.ndarray, bands: Bands) -> np.ndarray:
    """Hashes of the parts of a set, for each of its bands. Two linked sets share one.

    Of m parts, linked sets agree on m - D at least. A set's empty parts count only if there are so many of
    them that all parts agreed on might be empty.
    """
    out = []
    for band in bands.of(len(tokens)) if len(tokens) else []:
        m, d = bands.parts(band)
        if not d:
            continue  # linked sets of this band are equal
        part = (mix(tokens + _C3) >> _U(16)) % _U(m)
        order = np.argsort(part, kind="stable")
        found, first = np.unique(part[order], return_index=True)
        sums = np.add.reduceat(mix(tokens ^ _C3)[order], first)
        tag = _U(band) << _U(40)
        out.append(mix(mix(sums) + (found | tag) * _C3))
        if m - len(found) >= m - d:
            out.append(mix((np.setdiff1d(np.arange(m, dtype=np.uint64), found) | tag) * _C3))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity_sketch(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Words of 64 bits: bit i is set when an odd number of tokens has the remainder i. A power of two of bits, at
    least four for each token in which a set of that size may differ from a linked one, up to ``SKETCH_WORDS``."""
    differing = (100 - percent) * 2 * len(tokens) // (100 + percent)
    words = 1
    while words < SKETCH_WORDS and 64 * words < 4 * differing:
        words *= 2
    odd = np.bincount((tokens & _U(64 * words - 1)).astype(np.int64), minlength=64 * words).astype(np.uint8) & np.uint8(1)
    return np.packbits(odd).view(np.int64)


def link_by_sketches(sketches: Sequence[np.ndarray], sizes: np.ndarray, labels: np.ndarray, percent: int) -> list[np.ndarray]:
    """Places ``[i, m]`` of sets that may be linked, as many as it takes to join all such sets of different labels."""
    width = min(map(len, sketches))
    flat = np.stack([np.bitwise_xor.reduce(x.reshape(-1, width), axis=0) for x in sketches]).view(np.uint64)
    labels, sizes = np.array(labels, np.int64), np.asarray(sizes, np.int64)
    out = []
    for i in range(len(labels) - 1):
        m = i + 1 + np.flatnonzero(labels[i + 1 :] != labels[i])
        m = m[(np.minimum(sizes[m], sizes[i]) * 100 >= np.maximum(sizes[m], sizes[i]) * percent)]
        bits = np.bitwise_count(flat[m] ^ flat[i]).sum(axis=1, dtype=np.int64)
        for k in m[bits * (100 + percent) <= (sizes[m] + sizes[i]) * (100 - percent)]:
            if labels[k] != labels[i]:
                labels[labels == labels[k]] = labels[i]
                out.append(np.array([i, k]))
    return out


def _may_be_linked(a: str, b: str, percent: int) -> Column:
    """Whether the sizes ``n_x`` and sketches ``parity_x`` of two sets leave room for a link. Of sketches of different
    lengths (sets that may be linked differ by the factor two at most) the halves of the longer are laid together."""
    def fold(x: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))

    def differing(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda s, k: s + k)

    x, y = F.col(f"parity_{a}"), F.col(f"parity_{b}")
    bits = F.when(F.size(x) == F.size(y), differing(x, y)).when(F.size(x) > F.size(y), differing(fold(x), y)).otherwise(differing(x, fold(y)))
    n_a, n_b = F.col(f"n_{a}"), F.col(f"n_{b}")
    sized = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    return F.when(sized, bits * (100 + percent) <= (n_a + n_b) * (100 - percent)).otherwise(F.lit(False))


def _families(signed: DataFrame, percent: int) -> DataFrame:
    """``(node, family)`` of the nodes that may be linked with another: linked ones are in one family. ``signed`` has
    ``node, n, parity, signatures``."""
    cells = signed.select("node", F.explode("signatures").alias("sig"))
    # Signatures that several rows have are found first; they are few, and the rest need not move again for the join.
    shared = materialize(cells.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("sig"))
    met = materialize(sifted(cells, "sig", shared).join(shared, "sig"))
    leaders = met.groupBy("sig").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last").select("sig", "leader")
    members = materialize(met.join(leaders, "sig"))
    discard(shared, met)
    sketches = materialize(signed.select("node", "n", "parity").dropDuplicates(["node"]))  # rows may repeat
    sides = {x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("parity").alias(f"parity_{x}")) for x in "ab"}
    met = members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    links = materialize(met.join(sides["a"], "a").join(sides["b"], "b").where(_may_be_linked("a", "b", percent)).select("a", "b"))
    # What is still apart under one signature, after comparing all with its least document.
    first = connected_components(links)
    labelled = materialize(members.join(first, "node", "left").select("sig", "node", F.coalesce("label", "node").alias("label")))
    discard(members)
    apart = labelled.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("sig")
    rest = materialize(labelled.join(apart, "sig").distinct())
    discard(labelled)
    # A signature's documents are dealt into chunks; each two of them are a group, which joins what it can by few links.
    chunks = rest.groupBy("sig").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL)).alias("chunks"))
    dealt = rest.join(chunks, "sig").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    others = F.when(F.col("chunks") == 1, F.array("chunk")).otherwise(
        F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), F.col("chunk")))
    dealt = dealt.withColumn("other", F.explode(others)).select(
        "sig", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"), "node", "label")
    # Sketches join the slim rows on their way to the tasks.
    placed = dealt.join(sketches, "node").repartition("sig", "p", "q").sortWithinPartitions("sig", "p", "q", "node")

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(pdf: pd.DataFrame, ends: np.ndarray) -> pd.DataFrame:
            nodes, labels, sizes, parity = (pdf[c].to_numpy() for c in ("node", "label", "n", "parity"))
            found = [nodes[a + at] for a, b in zip([0, *ends], ends, strict=False) for at in link_by_sketches(parity[a:b], sizes[a:b], labels[a:b], percent)]
            return pd.DataFrame(np.array(found, np.int64).reshape(-1, 2), columns=["a", "b"])

        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf])
            keys = pdf[["sig", "p", "q"]].to_numpy()
            ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            yield done(pdf, ends)
            held = pdf[ends[-1] :] if len(ends) else pdf
        if held is not None:
            yield done(held, np.array([len(held)]))
        release_memory()

    more = materialize(placed.mapInPandas(join, "a long, b long").distinct())
    discard(rest, sketches)
    if not more.isEmpty():
        discard(first)
        first = connected_components(links.unionByName(more))
    discard(links, more)
    return first.select("node", F.col("label").alias("family"))


def link_by_groups(sets: list[np.ndarray], labels: np.ndarray, percent: int, side: np.ndarray | None = None,
                   group: int = GROUP) -> np.ndarray:
    """Labels of documents after joining those that are linked; similar sets should stand near each other.

    ``side``: compare only documents of different sides. Labels are numbers; of two joined, the smaller stays.
    """
    n = len(sets)
    labels = labels.copy()
    sizes = np.fromiter(map(len, sets), np.int64, n)
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    n_groups = -(-n // group)
    heads = np.arange(0, n, group)
    least, most = np.minimum.reduceat(sizes, heads), np.maximum.reduceat(sizes, heads)
    # The matrix: the groups of each token, one entry per token and group.
    owner = np.repeat((np.arange(n) // group).astype(np.int32), sizes)
    order = np.lexsort((owner, flat))
    tok, grp = flat[order], owner[order]
    del owner, order
    keep = np.concatenate([[True], (tok[1:] != tok[:-1]) | (grp[1:] != grp[:-1])]) if len(tok) else np.zeros(0, bool)
    tok, grp = tok[keep], grp[keep]
    for i in range(n):
        q, need = sets[i], -(-percent * int(sizes[i]) // 100)
        own = i // group
        if n_groups > 1:
            low, high = np.searchsorted(tok, q, side="left"), np.searchsorted(tok, q, side="right")
            counts = high - low
            at = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
            bound = np.bincount(grp[at], minlength=n_groups)
            open_groups = np.flatnonzero((bound >= need) & (most * 100 >= percent * sizes[i]) & (least * percent <= 100 * sizes[i]))
            open_groups = open_groups[open_groups >= own]
        else:
            open_groups = heads[:1]
        for g in open_groups:
            members = np.arange(max(i + 1, g * group), min(n, (g + 1) * group))
            wanted = (labels[members] != labels[i]) & (sizes[members] * 100 >= percent * sizes[i]) & (sizes[members] * percent <= 100 * sizes[i])
            if side is not None:
                wanted &= side[members] != side[i]
            members = members[wanted]
            if not len(members):
                continue
            theirs = np.concatenate([flat[starts[m] : starts[m + 1]] for m in members])
            where = np.minimum(np.searchsorted(q, theirs), len(q) - 1)
            shared = np.add.reduceat((q[where] == theirs).astype(np.int64), np.concatenate([[0], np.cumsum(sizes[members])[:-1]]))
            for m in members[100 * shared >= percent * (sizes[i] + sizes[members] - shared)]:
                a, b = labels[i], labels[m]
                if a != b:
                    labels[labels == max(a, b)] = min(a, b)
    return labels


def _joined_labels(nodes: pd.Series, labels: pd.Series, tokens: pd.Series, percent: int,
                   side: np.ndarray | None = None) -> np.ndarray:
    """New labels (nodes) of the documents of one family, which stand in order."""
    names, codes = np.unique(labels.to_numpy(np.int64), return_inverse=True)
    sets = [np.frombuffer(t, np.uint64) for t in tokens]
    return names[link_by_groups(sets, codes, percent, side)]


def _within_partitions(sets: DataFrame, percent: int, partition_bytes: int) -> DataFrame:
    """``(node, family, part, label)``: families in order over range partitions, each joined as far as it lies in
    one partition."""
    total = sets.agg(F.sum(F.octet_length("tokens"))).first()[0] or 0
    parts = max(sets.sparkSession.sparkContext.defaultParallelism, -(-total // partition_bytes))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()

        def done(rows: list[pd.DataFrame]) -> pd.DataFrame:
            one = pd.concat(rows)
            out = one[["node", "family"]].assign(part=part)
            return out.assign(label=_joined_labels(one["node"], one["node"], one["tokens"], percent))

        held: list[pd.DataFrame] = []
        for pdf in batches:
            for family, rows in pdf.groupby("family", sort=False):
                if held and held[0]["family"].iloc[0] != family:
                    yield done(held)
                    held = []
                held.append(rows)
        if held:
            yield done(held)
        release_memory()

    order = ["family", "least", "node"]
    laid = sets.repartitionByRange(int(parts), *order).sortWithinPartitions(*order)
    return materialize(laid.mapInPandas(join, "node long, family long, part int, label long"))


def _across(rows: DataFrame, sets: DataFrame, percent: int, partition_bytes: int) -> DataFrame:
    """Links between labels of one family that lie in different partitions: ``(a, b)``.

    ``rows``: ``family, part, low, high, node, label``, whose tokens are read from ``sets``. A family's partitions
    are dealt into as many consecutive chunks as its sets fill partitions; each chunk is compared with itself and
    the others, in rounds: with those as many places before and behind it, in a circle, as the round's number. A
    round moves every set twice at most and its shuffle files go before the next one, so disk does not grow with
    the number of chunks. Pairs of chunks are dealt out by family and both chunks, so that a large family's pairs
    are spread over tasks and no group holds more than two chunks.
    """

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["least", "node"])
        if pdf["label"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        new = _joined_labels(pdf["node"], pdf["label"], pdf["tokens"], percent, pdf["part"].to_numpy())
        moved = new != pdf["label"].to_numpy()
        out = pd.DataFrame({"a": pdf["label"].to_numpy()[moved], "b": new[moved]}).drop_duplicates()
        release_memory()
        return out

    told = rows.join(sets.select("node", "least", "tokens"), "node")
    size = told.groupBy("family").agg(F.ceil(F.sum(F.octet_length("tokens")) / partition_bytes).alias("chunks"))
    chunk = F.floor((F.col("part") - F.col("low")) * F.col("chunks") / (F.col("high") - F.col("low") + 1))
    # The pairs of chunks are settled on rows without tokens; tokens join them on their way to the tasks.
    chunked = materialize(rows.join(materialize(size), "family").withColumn("chunk", chunk).select(
        "family", "chunks", "chunk", "part", "node", "label"))
    most = chunked.agg(F.max("chunks")).first()[0] or 1

    def round_of(places: int) -> DataFrame:
        both = F.array_distinct(F.array(*[F.pmod(F.col("chunk") + F.lit(k), F.col("chunks")) for k in (places, -places)]))
        paired = chunked.where((F.col("chunks") >= 2 * places) | F.lit(places == 1)).withColumn("other", F.explode(both))
        paired = paired.select("family", F.least("chunk", "other").alias("p"), F.greatest("chunk", "other").alias("q"), "part", "node", "label")
        dealt = paired.join(sets.select("node", "least", "tokens"), "node").repartition("family", "p", "q")
        return materialize(dealt.groupBy("family", "p", "q").applyInPandas(compare, "a long, b long"))

    links = reduce(DataFrame.unionByName, [round_of(places) for places in range(1, max(1, most // 2) + 1)])
    discard(chunked)
    return links


def _renamed(links: DataFrame) -> DataFrame:
    return connected_components(links).select(F.col("node").alias("old"), F.col("label").alias("new"))


def _relabel(rows: DataFrame, new: DataFrame) -> DataFrame:
    return rows.join(new, rows.label == new.old, "left").withColumn("label", F.coalesce("new", "label")).drop("old", "new")


def _verified(sets: DataFrame, percent: int, partition_bytes: int) -> DataFrame:
    """``(node, label)`` of all candidates, written: equal labels for documents in one component of links."""
    placed = _within_partitions(sets, percent, partition_bytes)
    spread = placed.groupBy("family").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    # Partitions are consecutive, so at most one family runs over each border. Tokens stay in ``sets``.
    cut = materialize(placed.join(spread, "family").distinct())
    labels = materialize(placed.select("node", "label").distinct())  # a row that repeats has its set twice
    discard(placed)
    if cut.isEmpty():
        return labels
    links = _across(cut.where("node = label"), sets, percent, partition_bytes)  # one document for each component so far
    if not links.isEmpty():
        new, before = _renamed(links), (cut, labels)
        cut, labels = materialize(_relabel(cut, new)), materialize(_relabel(labels, new))
        discard(*before)
    apart = cut.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("family")
    links = _across(cut.join(apart, "family", "left_semi"), sets, percent, partition_bytes)
    discard(cut)
    if links.isEmpty():
        return labels
    before, labels = labels, materialize(_relabel(labels, _renamed(links)))
    discard(before)
    return labels


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                     percent: int = PERCENT, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Documents are linked when their sets of word n-grams have a Jaccard similarity of ``percent`` / 100 or
    more; ``component_id`` is the smallest id reachable over links. Null and empty texts, and texts of white
    space, have no n-gram, are linked with nothing and are their own component. Rows that repeat an id are
    taken one by one; a null id is taken, and returned, as -2^63. An empty table gives an empty result. Other
    columns are ignored.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col(text_col).alias("text"))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bands = Bands(percent)
        for pdf in batches:
            found = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                tokens = token_set(text, words)
                found.append((doc_id, len(tokens), *set_digest(tokens), parity_sketch(tokens, percent), signatures(tokens, bands).view(np.int64)))
            yield pd.DataFrame(found, columns=["doc_id", "n", "d1", "d2", "parity", "signatures"])
        release_memory()

    def with_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for x in pdf.itertuples(index=False):
                tokens = token_set(x.text, words)
                if (len(tokens), *set_digest(tokens)) == (x.n, x.d1, x.d2):  # else another row of the same id
                    found.append((x.family, x.node, tokens[:1].view(np.int64)[0], tokens.tobytes()))
            yield pd.DataFrame(found, columns=["family", "node", "least", "tokens"])
        release_memory()

    sketches = materialize(rows.mapInPandas(sketch, "doc_id long, n long, d1 long, d2 long, parity array<long>, signatures array<long>"))
    equal = ["n", "d1", "d2"]
    classes = materialize(sketches.where("n > 0").groupBy(*equal).agg(F.min("doc_id").alias("rep"))
                          .withColumn("node", F.monotonically_increasing_id()))
    signed = materialize(
        sketches.where(F.size("signatures") > 0).withColumnRenamed("doc_id", "rep").join(classes, [*equal, "rep"])
        .select("node", "n", "parity", "signatures"))
    slim = materialize(sketches.drop("parity", "signatures"))
    discard(sketches)
    families = _families(signed, percent)
    discard(signed)
    wanted = families.join(classes, "node").withColumnRenamed("rep", "doc_id")
    sets = materialize(rows.join(wanted, "doc_id").mapInPandas(with_tokens, "family long, node long, least long, tokens binary"))
    labels = _verified(sets, percent, partition_bytes)
    discard(families, sets)
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    components = named.join(smallest, "label").select(*equal, "component_id")
    return slim.join(components, equal, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
