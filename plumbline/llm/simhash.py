"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint is cut into blocks of segments; the numbers of one bits in the segments are its coordinates.  One differing bit
changes one coordinate by one, so the Manhattan distance of two embeddings is at most the Hamming distance of the fingerprints.
The join is a range join on the grid of coordinates: with at most ``radius`` differing bits, some block of ``B`` has at most
``radius // B`` of them, so its coordinates differ by at most that.  Each fingerprint sits in its own cell of every block (its home), and looks
into the cells one step up along each coordinate; of two fingerprints one step apart the lower one looks up into the home of the other.  What meets
in a cell is verified by its exact Hamming distance.

The home layout for radius 3 is two halves of 16 two-bit segments: 2 homes and about 24 looks for each fingerprint, and a cell is one of
3^16.  Nothing within the radius is missed.  For a radius that no exact layout can serve, ``sampled_layout`` draws many blocks of
single-bit segments and finds a pair in one of them with a stated probability.  For a similarity of word shingles ``near_classes`` takes the grid's pairs as
candidates beside those of a prefix filter, which is exact, and verifies all of them on the sets.

Equal fingerprints are one class from the start (with a similarity, equal sets of shingles are), and a cell yields links that span what it connects, not all pairs.  A cell
with more than ``most`` members is cut into runs, and pairs of runs are compared by separate tasks.

Null text counts as empty: no words, fingerprint zero.  Repeated rows share their class.  A null id is carried along; it is never the smallest
id of a component unless the component has no other.  Very long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import Scratch, parts, sliced, text_bytes
from plumbline.llm.components import components

MOST = 2048
FEW = 4
HASHES = 2 << 20
Layout = list[tuple[list[list[int]], bool]]
"""Blocks: (segments as lists of bit numbers, whether to look one step up)."""


def halves_layout() -> Layout:
    """Exact for 64 bits and up to 3 differing bits."""
    return [([[32 * h + 2 * s, 32 * h + 2 * s + 1] for s in range(16)], True) for h in range(2)]


def sampled_layout(bits: int, width: int, blocks: int, seed: int = 7) -> Layout:
    """``blocks`` blocks of ``width`` bits drawn at random: a pair that differs in a share p of its bits meets with
    probability 1 - (1 - (1 - p)^width)^blocks."""
    rng = np.random.default_rng(seed)
    return [([[int(b)] for b in rng.choice(bits, width, replace=False)], False) for _ in range(blocks)]


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each word shingle, repeats included; a shorter text is one shingle, one without words none."""
    got = (text or "").encode().lower().split()
    if not got:
        return np.empty(0, np.uint64)
    joined = b" ".join(got)
    if len(got) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    ends = (np.cumsum([len(w) + 1 for w in got]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends)]
    parts = [joined[i:j] for i, j in zip(starts, ends[words - 1 :])]
    return np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, len(parts))


def votes(h: np.ndarray, bits: int) -> np.ndarray:
    """How many hashes have each bit set; from bit 64 on, of hashes derived from the first 64."""
    out = np.zeros(bits, np.int64)
    for i in range(0, len(h), 1 << 16):
        part = h[i : i + (1 << 16)]
        for k in range(0, bits, 64):
            x = part
            if k:
                x = part + np.uint64((k // 64 * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x = x ^ (x >> np.uint64(31))
            out[k : k + 64] += np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return out


def node_of(h: np.ndarray) -> bytes:
    """128 bits of hash of a set of shingle hashes, sorted and distinct."""
    return xxhash.xxh3_128_digest(h.tobytes())


def ticket_of(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


def prefix_keys(h: np.ndarray) -> np.ndarray:
    """The upper 38 bits of sorted shingle hashes, without repeats."""
    k = h >> np.uint64(26)
    return k[np.concatenate([[True], k[1:] != k[:-1]])] if len(k) else k


def fingerprints(docs: DataFrame, words: int, bits: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp binary, node binary, ticket, size, keys): bit i of the fingerprint, the lowest first, is one where over half of the shingle
    hashes have it; node is 128 bits of hash of the set of shingle hashes and ticket 64 of them; the set has so many hashes and prefix keys."""
    slim = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            fps, nodes, sizes, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                h = shingle_hashes(text, words)
                fps.append(np.packbits(2 * votes(h, bits) > len(h), bitorder="little").tobytes())
                h = np.unique(h)
                nodes.append(node_of(h))
                sizes.append(len(h))
                keys.append(len(prefix_keys(h)))
            tickets = [ticket_of(x) for x in nodes]
            columns = [pa.array(x, k) for x, k in [(fps, pa.binary()), (nodes, pa.binary()), (tickets, pa.int64()), (sizes, pa.int64()), (keys, pa.int64())]]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "fp", "node", "ticket", "size", "keys"])

    return slim.mapInArrow(run, f"id {kind}, fp binary, node binary, ticket long, size long, keys long").withColumnRenamed("id", id_col)


def span(home: np.ndarray, looks: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that span the graph of homes with each other and with looks at a distance of at most ``radius``; all links of a few.

    Numbers below len(home) are homes, the others looks.
    """
    every = np.concatenate([home, looks])
    n = len(home)
    near = np.bitwise_count(every[:, None, :] ^ home[None, :, :]).sum(axis=2) <= radius
    if len(every) <= FEW:
        i, j = np.nonzero(near)
        i, j = i[i > j], j[i > j]
        return j.tolist(), i.tolist()
    a: list[int] = []
    b: list[int] = []
    fresh = np.ones(len(every), bool)
    for start in range(n):
        if not fresh[start]:
            continue
        fresh[start] = False
        front = [start]
        while front:
            x = front.pop()
            hit = near[:, x] if x < n else np.zeros(len(every), bool)
            if x >= n:
                hit[:n] = near[x]
            got = np.flatnonzero(hit & fresh).tolist()
            fresh[got] = False
            a.extend([x] * len(got))
            b.extend(got)
            front.extend(got)
    return a, b


def links(fps: DataFrame, radius: int, layout: Layout, bits: int = 64, most: int = MOST) -> DataFrame:
    """(a, b): pairs of distinct fingerprints that connect whatever is linked at ``radius`` differing bits or fewer."""
    spark = fps.sparkSession
    work = Scratch(spark, "simhash-links")
    size = bits // 8
    rng = np.random.default_rng(11)
    plan = []
    for segments, up in layout:
        weight = rng.integers(1, 1 << 62, len(segments), dtype=np.int64) * 2 + 1
        plan.append((segments, up, weight, int(rng.integers(1, 1 << 62))))

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.column("fp").slice(i, 4096)
                raw = np.frombuffer(b"".join(part.to_pylist()), np.uint8).reshape(-1, size)
                one = np.unpackbits(raw, axis=1, bitorder="little")
                for segments, up, weight, salt in plan:
                    counts = np.stack([one[:, s].sum(axis=1) for s in segments], axis=1).astype(np.int64)
                    with np.errstate(over="ignore"):
                        home = (counts * weight).sum(axis=1) + salt
                    cell, who, is_home = [home], [np.arange(len(raw))], [np.ones(len(raw), bool)]
                    if up:
                        r, s = np.nonzero(counts < np.array([len(x) for x in segments]))
                        with np.errstate(over="ignore"):
                            cell.append(home[r] + weight[s])
                        who.append(r)
                        is_home.append(np.zeros(len(r), bool))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(cell)), part.take(pa.array(np.concatenate(who))), pa.array(np.concatenate(is_home))], ["cell", "fp", "home"]
                    )

    def rows_of(fp: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(fp.to_pylist()), "<u8").reshape(-1, size // 8) if len(fp) else np.empty((0, size // 8), np.uint64)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell.  Links of small cells; of a large one its members by runs, for the second step."""
        names = ["cell", "run", "a", "b", "home"]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.bool_()]
        out: list[list] = [[] for _ in names]

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names)
            for x in out:
                x.clear()
            return got

        def put(cell: int, run: int | None, a: list[bytes], b: list, home: list) -> None:
            for x, v in zip(out, ([cell] * len(a), [run] * len(a), a, b, home)):
                x.extend(v)

        def close(cell: int, fp: list[bytes], home: np.ndarray) -> None:
            if len(fp) < 2 or not home.any():
                return
            order = np.argsort(~home, kind="stable")
            fp, n = [fp[i] for i in order], int(home.sum())
            v = np.frombuffer(b"".join(fp), "<u8").reshape(len(fp), -1)
            a, b = span(v[:n], v[n:], radius)
            if a:
                put(cell, None, [fp[i] for i in a], [fp[i] for i in b], [None] * len(a))

        now, fps_held, home_held, runs = None, [], [], 0
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            if not len(cell):
                continue
            fp, home = batch.column("fp").to_pylist(), batch.column("home").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(cell)) + 1).tolist(), len(cell)]
            starts = cell[cuts[:-1]].tolist()
            for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                if starts[k] != now:
                    if runs:
                        put(now, runs, fps_held, [None] * len(fps_held), home_held)
                    elif len(fps_held) > 1:
                        close(now, fps_held, np.array(home_held))
                    now, fps_held, home_held, runs = starts[k], [], [], 0
                fps_held.extend(fp[i:j])
                home_held.extend(home[i:j].tolist())
                while len(fps_held) > most:
                    put(now, runs, fps_held[:most], [None] * most, home_held[:most])
                    fps_held, home_held, runs = fps_held[most:], home_held[most:], runs + 1
                if len(out[0]) > 20_000:
                    yield flush()
        if runs:
            put(now, runs, fps_held, [None] * len(fps_held), home_held)
        elif len(fps_held) > 1:
            close(now, fps_held, np.array(home_held))
        yield flush()

    distinct = fps.select("fp").where(F.octet_length("fp") == size).distinct()
    dealt = distinct.mapInArrow(cells, "cell long, fp binary, home boolean")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(count, "cell").sortWithinPartitions("cell")
    found = work.write(dealt.mapInArrow(meet, "cell long, run int, a binary, b binary, home boolean"), "found")
    direct = found.where("run is null").select("a", "b")

    members = found.where("run is not null")
    runs = members.groupBy("cell").agg((F.max("run") + 1).alias("runs"))
    # every pair of runs once: run i meets i..runs-1, so each member is copied once for each run of its own cell
    copies = members.join(runs, "cell").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)))
    copies = copies.select("cell", F.least("run", "other").alias("i"), F.greatest("run", "other").alias("j"), F.col("run").alias("mine"), F.col("a").alias("fp"), "home")

    def pair(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        fp, home = pdf["fp"].tolist(), pdf["home"].to_numpy(bool)
        order = np.argsort(~home, kind="stable")
        fp, n = [fp[k] for k in order], int(home.sum())
        v = np.frombuffer(b"".join(fp), "<u8").reshape(len(fp), -1)
        a, b = span(v[:n], v[n:], radius) if n else ([], [])
        return pd.DataFrame({"a": [fp[k] for k in a], "b": [fp[k] for k in b]}, columns=["a", "b"])

    return direct.unionByName(copies.groupBy("cell", "i", "j").applyInPandas(pair, "a binary, b binary")).distinct()


def near_classes(
    docs: DataFrame,
    words: int = 3,
    radius: int = 3,
    layout: Layout | None = None,
    bits: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    most: int = MOST,
    similarity: float | None = None,
) -> DataFrame:
    """(id, fp, component): component is the smallest id among the documents reachable over links.

    With ``similarity`` these links only make families; inside a family a link is that Jaccard similarity of two shingle sets, computed exactly
    for every pair that verified links do not connect already.
    """
    work = Scratch(docs.sparkSession, "simhash")
    held = work.write(fingerprints(docs, words, bits, id_col, text_col), "fingerprints")
    pairs = links(held, radius, layout or halves_layout(), bits, most)
    if similarity is None:
        key, roots = "fp", components(pairs, "simhash-components")
    else:
        key, roots = "node", components(_similar(docs, held, pairs, words, similarity, id_col, text_col, work), "simhash-verified")
    first = held.groupBy(key).agg(F.min(id_col).alias("least"))
    rooted = first.join(roots, first[key] == roots["node"], "left").select(first[key].alias("__node"), "least", F.coalesce("root", first[key]).alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(whole, "root").select("__node", "component")
    return held.join(named, F.col(key) == F.col("__node")).select(id_col, "fp", "component")


def alike(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: float, known: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links between sets in ``left`` and sets in ``right`` (places in ``sets``) at a Jaccard similarity of at least ``similarity`` that span
    what such links connect.  A pair stays uncompared only if links already connect it; places of one number in ``known`` are connected from
    the start, so that each link joins two groups.  The same places on both sides mean all pairs of them."""
    total = sum(map(len, sets))
    dense = np.unique(np.concatenate([*sets, np.empty(0, np.int64)]), return_inverse=True)[1]
    size = np.array([len(x) for x in sets], np.int64)
    part = np.split(dense, np.cumsum(size)[:-1])
    seen = np.zeros(total, bool)
    within = len(left) == len(right) and bool((left == right).all())
    group = np.arange(len(sets)) if known is None else known.copy()
    a: list[int] = []
    b: list[int] = []
    for at, x in enumerate(left.tolist()):
        other = right[at + 1 :] if within else right
        least, most = np.minimum(size[other], size[x]), np.maximum(size[other], size[x])
        other = other[(group[other] != group[x]) & (least > 0) & (least >= similarity * most)]
        if not len(other):
            continue
        seen[part[x]] = True
        starts = np.concatenate([[0], np.cumsum(size[other])[:-1]])
        common = np.add.reduceat(seen[np.concatenate([part[k] for k in other.tolist()])], starts, dtype=np.int64)
        seen[part[x]] = False
        for y in other[common >= similarity * (size[other] + size[x] - common)].tolist():
            if group[y] != group[x]:
                group[group == group[y]] = group[x]
                a.append(x)
                b.append(y)
    return a, b


def prefix_links(docs: DataFrame, held: DataFrame, words: int, similarity: float, text_col: str, work: Scratch) -> DataFrame:
    """(a, b): pairs of nodes that connect any two whose sets have a Jaccard similarity of at least ``similarity``, and others.

    With keys ordered from the rarest, two such sets share a key among the first ``size - ceil(similarity * size) + 1`` of each.  Keys that
    one set alone has come first and link nothing, so a set with enough of them links nothing at all.  Keys are dealt by value, packed
    as 4 bytes and a ticket of 8; sets that share a key of their prefixes are linked to the smallest of them.
    """
    spark = docs.sparkSession
    count = max(64, parts(spark, 2 * text_bytes(docs, text_col)[1], 16 << 20))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            got = [np.unique(shingle_hashes(t, words)) for t in batch.column("text").to_pylist()]
            keys = [prefix_keys(h) for h in got]
            who = np.repeat(np.array([ticket_of(node_of(h)) for h in got], "<i8"), [len(k) for k in keys])
            every = np.concatenate(keys)
            part, rest = (every % np.uint64(count)).astype(np.int32), (every // np.uint64(count)).astype("<u4")
            order = np.argsort(part, kind="stable")
            part, rest, who = part[order], rest[order], who[order]
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)] if len(part) else []
            spans = list(zip(cuts, cuts[1:]))
            columns = [pa.array([part[i] for i, _ in spans], pa.int32()), *(pa.array([x[i:j].tobytes() for i, j in spans], pa.binary()) for x in (rest, who))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "rest", "who"])

    def shared(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        rest, who = np.frombuffer(b"".join(pdf["rest"]), "<u4"), np.frombuffer(b"".join(pdf["who"]), "<i8")
        order = np.lexsort((who, rest))
        rest, who = rest[order], who[order]
        keep = np.concatenate([[True], (rest[1:] != rest[:-1]) | (who[1:] != who[:-1])])
        rest, who = rest[keep], who[keep]
        starts = np.flatnonzero(np.concatenate([[True], rest[1:] != rest[:-1]]))
        n = np.diff(np.append(starts, len(rest)))
        n = np.repeat(n, n)
        some = n > 1
        return pd.DataFrame({"ticket": who[some], "n": n[some], "key": rest[some].astype(np.int64) * count + int(pdf["part"].iloc[0])})

    slim = docs.select(docs[text_col].alias("text"))
    packed = slim.mapInArrow(pack, "part int, rest binary, who binary")
    common = packed.groupBy("part").applyInPandas(shared, "ticket long, n long, key long")
    common = common.groupBy("ticket").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("common"))
    sizes = held.groupBy("node").agg(F.first("ticket").alias("ticket"), F.first("size").alias("size"), F.first("keys").alias("keys"))
    # what the keys of this set alone leave of the prefix
    left = F.col("size") - F.ceil(F.lit(similarity) * F.col("size") - 1e-6) + 1 - (F.col("keys") - F.size("common"))
    first = common.join(sizes, "ticket").withColumn("left", left.cast("int")).where("left > 0").select("node", F.explode(F.slice("common", F.lit(1), F.col("left"))["key"]).alias("key"))
    first = work.write(first, "prefixes")
    least = first.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return first.join(least, "key").where("node != a").select("a", F.col("node").alias("b")).distinct()


def _similar(docs: DataFrame, held: DataFrame, pairs: DataFrame, words: int, similarity: float, id_col: str, text_col: str, work: Scratch) -> DataFrame:
    """(a, b): pairs of nodes (sets of shingles) that connect whatever is linked by the similarity.  They are looked for inside families:
    nodes that are connected by equal fingerprints, by the ``pairs`` of fingerprints or by prefixes of their sets.

    Every pair of a family is compared exactly unless verified links already connect it.  A family is dealt into runs: up to 16 runs of at least
    64 members for the spread, more so that a run has about ``MOST`` members and ``HASHES`` hashes.  Each run is grouped first; then pairs of runs are
    compared by separate tasks, which link groups that are still apart.  So m near copies yield fewer than m links, and one more for each pair of runs.
    Documents with equal sets are one node, which stands for the one with the smallest id."""
    nodes = work.write(held.groupBy("fp", "node").agg(F.min(id_col).alias("least"), F.first("size").alias("size")), "nodes")
    head = nodes.groupBy("fp").agg(F.min("node").alias("head"))
    equal = nodes.join(head, "fp").where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    grid = pairs.join(head.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(head.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    every = equal.unionByName(grid.select(F.col("x").alias("a"), F.col("y").alias("b"))).unionByName(prefix_links(docs, held, words, similarity, text_col, work))
    near = components(every, "simhash-families")
    # one set can have several fingerprints, as those count repeats
    least = nodes.groupBy("node").agg(F.min("least").alias("__least"), F.first("size").alias("size"))
    wanted = work.write(near.join(least, "node").select(F.col("root").alias("family"), F.col("node").alias("key"), "__least", "size"), "wanted")
    n = F.count(F.lit(1))
    runs = F.greatest(F.least(F.ceil(n / 64), F.lit(16)), F.ceil(n / MOST), F.ceil(F.sum("size") / HASHES)).cast("int")
    dealt = wanted.join(wanted.groupBy("family").agg(runs.alias("runs")), "family").withColumn("run", F.pmod(F.xxhash64("key"), F.col("runs")).cast("int"))
    names = ["family", "run", "runs", "key"]
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(dealt, F.col("id") == F.col("__least")).select(*names, "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            got = [np.unique(shingle_hashes(t, words)).astype(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(got, pa.list_(pa.int64()))], [*names, "hashes"])

    shape = "family binary, run int, runs int, key binary"
    ready = texts.mapInArrow(sets, f"{shape}, hashes array<long>").dropDuplicates(["key"])

    def grouped(pdf):  # noqa: ANN001, ANN202
        """Each member of a run with the smallest key that it is connected with inside the run."""
        pdf = pdf.sort_values("key", ignore_index=True)
        got, every = pdf["key"].tolist(), np.arange(len(pdf))
        group = every.copy()
        for x, y in zip(*alike(pdf["hashes"].tolist(), every, every, similarity)):
            group[group == max(group[x], group[y])] = min(group[x], group[y])
        pdf["root"] = [got[k] for k in group.tolist()]
        if pdf["runs"].iloc[0] == 1:
            pdf["hashes"] = None  # nothing is left to compare
        return pdf

    local = work.write(ready.groupBy("family", "run").applyInPandas(grouped, f"{shape}, hashes array<long>, root binary"), "local")
    inside = local.where("key != root").select(F.col("root").alias("a"), F.col("key").alias("b"))
    others = F.filter(F.sequence(F.lit(0), F.col("runs") - 1), lambda k: k != F.col("run"))
    meeting = local.where("runs > 1").withColumn("other", F.explode(others))
    meeting = meeting.select("family", F.least("run", "other").alias("i"), F.greatest("run", "other").alias("j"), "run", "key", "root", "hashes")

    def pair(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        got, run = pdf["root"].tolist(), pdf["run"].to_numpy()
        names = {v: k for k, v in enumerate(dict.fromkeys(got))}
        known = np.array([names[v] for v in got])
        i, j = np.flatnonzero(run == pdf["i"].iloc[0]), np.flatnonzero(run == pdf["j"].iloc[0])
        a, b = alike(pdf["hashes"].tolist(), i, j, similarity, known)
        return pd.DataFrame({"a": [got[k] for k in a], "b": [got[k] for k in b]}, columns=["a", "b"])

    return inside.unionByName(meeting.groupBy("family", "i", "j").applyInPandas(pair, "a binary, b binary"))


CORPUS_WORDS, CORPUS_SIMILARITY, CORPUS_RADIUS = 5, 0.8, 3


def keep_one(
    docs: DataFrame,
    words: int = CORPUS_WORDS,
    similarity: float = CORPUS_SIMILARITY,
    radius: int = CORPUS_RADIUS,
    layout: Layout | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id (null ids last), then the smallest hash of its text.

    Near copies have a Jaccard similarity of at least ``similarity`` on shingles of ``words`` words.  None is missed but for chance collisions of
    64-bit hashes: the popcount grid finds all fingerprints within ``radius`` bits, the prefixes of the sets bring every other pair.
    """
    layout = layout or halves_layout()
    bits = 64 * (max(b for segments, _ in layout for s in segments for b in s) // 64 + 1)
    unknown, known, hashed = F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`"))
    keyed = docs.select(F.struct(unknown.alias("unknown"), known.alias("id"), hashed.alias("hash")).alias("__key"), F.col(f"`{text_col}`").alias("__text"))
    classes = near_classes(keyed, words, radius, layout, bits, "__key", "__text", similarity=similarity)
    kept = classes.where(F.col("__key") == F.col("component")).select(F.col("__key.id").alias("__id"), F.col("__key.hash").alias("__hash")).distinct()
    rows = docs.withColumn("__h", hashed)
    rows = rows.join(kept, known.eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")), "left_semi")
    return rows.dropDuplicates([id_col, "__h"]).select(*[F.col(f"`{c}`") for c in docs.columns])
