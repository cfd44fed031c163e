"""MinHash near-dedup with BagMinHash signatures.

A document is the multiset of its five-word shingles (a shorter text: all its words as one). Each shingle runs Poisson
processes over the dyadic intervals of its weight axis, [0, 1), [1, 2), [2, 4) and so on; a point counts if it lies below
the shingle's weight, and each signature component keeps its earliest point. Two signatures agree in a component with
probability equal to the weighted Jaccard similarity. Points come in ascending order and stop at the signature's maximum.

Equal texts form classes first. Band collisions are checked exactly: each bucket's members against its first one, then
the members of buckets that still hold several components, block against block, each pair in the first bucket it shares;
a one-bit sketch spares the pairs that are far from alike. Each block is compared with itself, then runs of blocks, SPAN
times as long each time, with their neighbours. Of a task's links only those leave it that connect its components, of all
tasks' links one for two components, and what they connect counts as one component next time. That gives the components;
links are all pairs of class representatives of similarity 0.8 or more, and none leads out of a component, so each
component's texts are compared pairwise, block by block. Null texts link with nothing; empty texts are copies of each other.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.batches import in_small_batches
from tallymill.llm.components import components
from tallymill.session import settle

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares a band with probability 0.9998.
BANDS, ROWS = 36, 7
SIZE = BANDS * ROWS
#: Differing bits out of SIZE that a pair of similarity 0.8 exceeds with probability under 0.00001.
MOST_BITS = 46
#: Texts of a component or bucket that one task compares with as many others.
BLOCK = 128
#: Runs of a bucket's blocks that are compared with each other at a time; together they are one run the next time.
SPAN = 8
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + MIX[0]).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * MIX[1]
        x = (x ^ (x >> np.uint64(27))) * MIX[2]
        return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def shingle_counts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text, as hashes, with their counts."""
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    wide = min(SHINGLE, len(hashes))
    out = np.full(len(hashes) - wide + 1, np.uint64(wide))
    with np.errstate(over="ignore"):
        for k in range(wide):
            out = mixed(out * MIX[1] + hashes[k : len(hashes) - wide + 1 + k])
    return np.unique(out, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Earliest point of each component, documents by components."""
    doc = np.repeat(np.arange(len(bags)), [len(h) for h, _ in bags])
    hashes = np.concatenate([h for h, _ in bags]) if bags else np.empty(0, np.uint64)
    weight = np.concatenate([c for _, c in bags]) if bags else np.empty(0, np.int64)
    start, length = np.zeros(len(doc), np.int64), np.ones(len(doc), np.int64)
    parts = [(doc, hashes, weight, start, length)]
    low = 1
    while (more := weight > low).any():
        doc, hashes, weight = doc[more], hashes[more], weight[more]
        parts.append((doc, mixed(hashes ^ mixed(np.uint64([low]))), weight, np.full(len(doc), low), np.full(len(doc), low)))
        low *= 2
    doc, seed, weight, start, length = (np.concatenate(x) for x in zip(*parts, strict=True))
    time = np.zeros(len(doc))
    best = np.full(len(bags) * SIZE, np.inf)
    while len(doc):
        seed = mixed(seed)
        time = time - np.log((((seed >> np.uint64(11)).astype(float)) + 0.5) / 2**53) / length
        limit = best.reshape(-1, SIZE).max(axis=1)
        going = time < limit[doc]
        doc, seed, weight, start, length, time = (x[going] for x in (doc, seed, weight, start, length, time))
        place = mixed(seed ^ MIX[2])
        level = start + ((place >> np.uint64(32)) % length.astype(np.uint64)).astype(np.int64)
        slot = doc * SIZE + ((place & np.uint64(0xFFFFFFFF)) % np.uint64(SIZE)).astype(np.int64)
        counts = level < weight
        np.minimum.at(best, slot[counts], time[counts])
    return best.reshape(-1, SIZE)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of equal texts; null for null texts), band hashes and one bit per component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                split = [words(t or "") for t in part["text"]]
                number = {w: xxhash.xxh3_64_intdigest(w) for w in set().union(*split)}
                bags = [shingle_counts(np.array([number[w] for w in s], dtype=np.uint64)) for s in split]
                best = signatures(bags).view(np.uint64)
                mixes = mixed(best)
                band = np.full((len(part), BANDS), np.uint64(7))
                for k in range(ROWS):
                    band = mixed(band ^ mixes[:, k::ROWS])
                band = mixed(band + np.arange(BANDS, dtype=np.uint64))
                bits = np.zeros((len(part), 256), np.uint8)
                bits[:, :SIZE] = (mixes >> np.uint64(17)) & np.uint64(1)
                yield pd.DataFrame(
                    {
                        "doc_id": part["doc_id"].astype("Int64"),
                        "key": [
                            None if t is None else xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in part["text"]
                        ],
                        "bands": [b.view(np.int64) if s else None for b, s in zip(band, split, strict=True)],
                        "bits": list(np.packbits(bits, axis=1).view(np.int64)),
                    }
                )

    schema = "doc_id long, key binary, bands array<long>, bits array<long>"
    return in_small_batches(docs).select("doc_id", "text").mapInPandas(run, schema)


def similarity(a: str, b: str) -> float:
    """Exact weighted Jaccard of two texts' shingles."""

    def bag(text: str) -> Counter:
        w = words(text)
        wide = min(SHINGLE, len(w))
        return Counter(tuple(w[k : k + wide]) for k in range(len(w) - wide + 1)) if w else Counter()

    x, y = bag(a), bag(b)
    most = (x | y).total()
    return (x & y).total() / most if most else 1.0


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    @F.pandas_udf("double")
    def exact(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype=float)

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = settle(pairs, f"{name}-pairs").join(right, "b").join(left, "a")
    return settle(both.select("a", "b", exact("text_a", "text_b").alias("similarity")).where(f"similarity >= {SIMILARITY}"), name)


def exact_bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts one after the other, numbered from 0, their counts, and where each text's begin."""
    number: dict[bytes, int] = {}
    split = [np.array([number.setdefault(w, len(number)) for w in words(t)], dtype=np.int64) for t in texts]
    wide = np.array([min(SHINGLE, len(s)) for s in split], dtype=np.int64)
    many = np.array([len(s) for s in split], dtype=np.int64) - wide + (wide > 0)
    own = np.repeat(np.arange(len(texts)), many)
    ids = np.zeros(len(own), np.int64)
    # Ranks of one word, of two and so on: equal ranks mean equal shingles; a short text's are padded.
    for k in range(SHINGLE):
        # No word is numbered -1; it stands where a short text has no further word.
        step = [s[k : k + m] if k < w else np.full(m, -1) for s, m, w in zip(split, many, wide, strict=True)]
        ids = np.unique(ids * (len(number) + 1) + np.concatenate(step) + 1, return_inverse=True)[1]
    pairs, counts = np.unique(own * (ids.max(initial=0) + 1) + ids, return_counts=True)
    own, ids = np.divmod(pairs, ids.max(initial=0) + 1)
    return ids, counts, np.searchsorted(own, np.arange(len(texts) + 1))


def near_pairs(texts: list[str], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (x, y) of texts from left and right with a similarity of SIMILARITY or more, and that similarity, exactly."""
    ids, counts, edges = exact_bags(texts)
    total = np.add.reduceat(np.append(counts, 0), edges[:-1]) * (np.diff(edges) > 0)
    at = np.concatenate([np.arange(edges[y], edges[y + 1]) for y in right]) if len(right) else np.empty(0, np.int64)
    many = np.diff(edges)[right]
    starts, right_ids, right_counts = np.cumsum(many) - many, ids[at], counts[at]
    own = np.zeros(ids.max(initial=0) + 1, np.int64)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for x in left:
        mine = slice(edges[x], edges[x + 1])
        own[ids[mine]] = counts[mine]
        both = np.add.reduceat(np.append(np.minimum(own[right_ids], right_counts), 0), starts) * (many > 0)
        own[ids[mine]] = 0
        either = total[x] + total[right] - both
        near = both / np.maximum(either, 1)
        hit = near >= SIMILARITY
        found.append((np.full(hit.sum(), x), right[hit], near[hit]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _compared(group: pd.DataFrame) -> pd.DataFrame:
    """The links (a, b, similarity) of one block with itself or with another one."""
    group = group.sort_values("doc_id", ignore_index=True)
    low, high = group["low"].iat[0], group["high"].iat[0]
    place = np.arange(len(group))
    left, right = (place[group["block"].to_numpy() == k] for k in (low, high))
    x, y, near = near_pairs(group["text"].tolist(), left, right)
    if low == high:
        x, y, near = x[x < y], y[x < y], near[x < y]
    ids = group["doc_id"].to_numpy()
    return pd.DataFrame({"a": np.minimum(ids[x], ids[y]), "b": np.maximum(ids[x], ids[y]), "similarity": near})


def _ends(group: pd.DataFrame) -> pd.DataFrame:
    """The links of one pair of blocks, counted by their ends."""
    links = _compared(group)
    ids, n = np.unique(np.concatenate([links["a"], links["b"]]).astype(np.int64), return_counts=True)
    return pd.DataFrame({"class_id": ids, "n": n})


@dataclass(frozen=True)
class Links:
    """All links: those of components of two texts as found, those of larger ones by comparing their blocks."""

    of_two: DataFrame
    blocks: DataFrame

    def pairs(self) -> DataFrame:
        """a, b, similarity."""
        found = self.blocks.groupBy("component", "low", "high").applyInPandas(_compared, "a long, b long, similarity double")
        return self.of_two.unionByName(found)

    def counts(self) -> DataFrame:
        """class_id and the number of its links; counted where they are found, so that no pair leaves its task."""
        found = self.blocks.groupBy("component", "low", "high").applyInPandas(_ends, "class_id long, n long")
        two = self.of_two.select(F.explode(F.array("a", "b")).alias("class_id"), F.lit(1).cast("long").alias("n"))
        return two.unionByName(found).groupBy("class_id").agg(F.sum("n").alias("n"))


def _in_blocks(rows: DataFrame, n: str, width: int | None = None) -> DataFrame:
    """Rows with their block of a group of n, once for each pair of blocks (low, high) that theirs is in; with a width, for
    pairs of runs of so many blocks among SPAN such runs alone, with width 0 for its block with itself alone."""
    blocks, block = F.ceil(F.col(n) / BLOCK).cast("int"), F.col("block")
    if width is None:
        others = F.sequence(F.lit(0), blocks - 1)
    elif width == 0:
        others = F.array(block)
    else:
        first = F.floor(block / (SPAN * width)).cast("int") * SPAN * width
        run = F.sequence(first, F.least(first + SPAN * width, blocks) - 1)
        others = F.filter(run, lambda k: F.floor(k / width) != F.floor(block / width))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
    other = dealt.withColumn("other", F.explode(others))
    return other.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other", n)


def _all_links(links: DataFrame, groups: DataFrame, texts: DataFrame) -> Links:
    """From the links that connect the components and the components of their nodes."""
    sizes = settle(groups.groupBy("component").agg(F.count("*").alias("n")), "sizes")
    named = links.join(groups.select(F.col("node").alias("a"), "component"), "a")
    of_two = named.join(sizes.where("n = 2"), "component").select("a", "b", "similarity")
    rows = groups.join(sizes.where("n > 2"), "component").select(F.col("node").alias("doc_id"), "component", "n")
    return Links(of_two, _in_blocks(settle(rows.join(texts, "doc_id"), "blocks"), "n"))


UNIT = ["bucket", "low", "high"]


def _forest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places of links (x, y) that connect all that these links connect, without rings."""
    ends = np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1)
    up: dict[int, int] = {}

    def top(node: int) -> int:
        while (above := up.get(node, node)) != node:
            up[node] = up.get(above, above)
            node = above
        return node

    kept = []
    for at in np.unique(ends, axis=0, return_index=True)[1].tolist():
        low, high = sorted(top(int(end)) for end in ends[at])
        if low < high:
            up[high] = low
            kept.append(at)
    return np.array(kept, dtype=np.int64)


def _open_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links between different components (low, high) in a bucket's block with itself or with another one, as many as
    connect all that are linked."""
    bucket, low, high = (group[c].iat[0] for c in UNIT)
    left, right = (np.flatnonzero(group["block"].to_numpy() == k) for k in (low, high))
    ids, component = group["doc_id"].to_numpy(), group["component"].to_numpy()
    bits, bands = (np.stack(group[c].to_list()).astype(np.int64) for c in ("bits", "bands"))
    # Of a negative number bitwise_count counts the bits of its absolute value.
    bits = bits.view(np.uint64)
    open_ = component[left][:, None] != component[right]
    if low == high:
        open_ &= ids[left][:, None] < ids[right]
    open_ &= sum(np.bitwise_count(bits[left, k][:, None] ^ bits[right, k]).astype(int) for k in range(bits.shape[1])) <= MOST_BITS
    x, y = np.nonzero(open_)
    same = bands[left[x]] == bands[right[y]]
    here = bands[left[x], same.argmax(axis=1)] == bucket
    x, y = left[x[here]], right[y[here]]
    used, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    if not len(used):
        return pd.DataFrame({"a": ids[x], "b": ids[y], "similarity": np.empty(0), "low": ids[x], "high": ids[y]})
    x, y = np.split(place, 2)
    texts = group["text"].to_numpy()[used].tolist()
    u, v, near = near_pairs(texts, np.unique(x), np.unique(y))
    found = np.isin(u * len(used) + v, x * len(used) + y)
    u, v, near, ids, component = u[found], v[found], near[found], ids[used], component[used]
    kept = _forest(component[u], component[v])
    u, v, near = u[kept], v[kept], near[kept]
    ends = {"a": np.minimum(ids[u], ids[v]), "b": np.maximum(ids[u], ids[v]), "similarity": near}
    return pd.DataFrame(
        ends | {"low": np.minimum(component[u], component[v]), "high": np.maximum(component[u], component[v])}
    )


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole pairs of blocks, which follow each other in the batches; the last one of a batch may go on in the next."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = rows[UNIT].to_numpy()
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
        for a, b in zip(edges, edges[1:], strict=False):
            yield rows.iloc[a:b]
        held = rows.iloc[edges[-1] :]
    if held is not None and len(held):
        yield held


def _linked_in_buckets(
    members: DataFrame, wanted: DataFrame, links: DataFrame, classes: DataFrame, texts: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """The given links with those that connect what else is linked in a bucket, and every member's component."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from map(_open_links, _units(batches))

    homes = wanted.join(components(links).withColumnRenamed("node", "doc_id"), "doc_id", "left")
    homes = settle(homes.select("doc_id", F.coalesce("component", "doc_id").alias("component")), "homes")
    content = settle(classes.select("doc_id", "bits", "bands").join(texts, "doc_id"), "content")
    rest, width = members, 0
    while True:
        placed = rest.select("bucket", "doc_id").join(homes, "doc_id")
        mixed = placed.groupBy("bucket").agg(
            F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("n")
        )
        mixed = settle(mixed.where("first < last").select("bucket", "n"), "open")
        if mixed.isEmpty():
            return links, homes
        rest = settle(placed.join(mixed, "bucket"), "rest")
        rows = settle(rest.join(content, "doc_id"), "rest-texts")
        units = in_small_batches(_in_blocks(rows, "n", width)).repartition(*UNIT).sortWithinPartitions(*UNIT)
        found = units.mapInPandas(run, "a long, b long, similarity double, low long, high long")
        found = settle(found.groupBy("low", "high").agg(F.min(F.struct("a", "b", "similarity")).alias("link")), "rest-links")
        if not found.isEmpty():
            links = links.unionByName(found.select("link.*"))
            joined = components(found.select(F.col("low").alias("a"), F.col("high").alias("b")))
            joined = joined.select(F.col("node").alias("component"), F.col("component").alias("now"))
            homes = homes.join(joined, "component", "left").select("doc_id", F.coalesce("now", "component").alias("component"))
            homes = settle(homes, "homes")
        width = max(1, SPAN * width)
        # Buckets of one run are done.
        rest = rest.where(F.col("n") > BLOCK * width)


def near_dedup(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, class_id, component_id, kept) of every document, and all links (a, b, similarity) between representatives."""
    out, links = near_dedup_links(docs)
    return out, links.pairs()


def near_dedup_links(docs: DataFrame) -> tuple[DataFrame, Links]:
    out, links, nodes, texts = _connected(docs)
    return out, _all_links(links, nodes, texts)


def representatives(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, component_id, kept) alone, without looking for the links that a component doesn't need."""
    return _connected(docs)[0]


def _connected(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Every document's class and component, the links that connect them, the nodes that may be linked, and the texts."""
    marks = settle(signed(docs), "signatures")
    classes = settle(
        marks.where("key is not null").groupBy("key").agg(F.min(F.struct("doc_id", "bands", "bits")).alias("first")).select(
            "key", "first.*"
        ),
        "classes",
    )
    rows = classes.where("bands is not null").select("doc_id", F.explode("bands").alias("bucket"))
    shared = settle(
        rows.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.count("*").alias("n")).where("n > 1").select("bucket", "a"),
        "buckets",
    )
    members = settle(rows.join(shared, "bucket"), "members")
    wanted = settle(members.select("doc_id").distinct(), "wanted")
    texts = docs.where("text is not null").join(wanted, "doc_id", "left_semi")
    texts = settle(texts.groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    star = settle(members.select("a", F.col("doc_id").alias("b")).where("a < b").distinct(), "stars")
    sketches = [classes.select(F.col("doc_id").alias(k), F.col("bits").alias(f"bits_{k}")) for k in ("a", "b")]
    differ = sum((F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k])) for k in range(4)), F.lit(0))
    near = star.join(sketches[0], "a").join(sketches[1], "b").where(differ <= MOST_BITS).select("a", "b")
    links = _verified(near, texts, "star")
    links, homes = _linked_in_buckets(members, wanted, links, classes, texts)
    nodes = homes.withColumnRenamed("doc_id", "node")
    groups = nodes.select(F.col("node").alias("class_id"), "component")
    named = marks.join(classes.select("key", F.col("doc_id").alias("class_id")), "key", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id")
    )
    out = named.join(groups, "class_id", "left").select(
        "doc_id", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id")), links, nodes, texts
