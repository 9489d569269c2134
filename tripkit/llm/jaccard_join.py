"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of distinct 5-word shingles; two link when their Jaccard similarity is 0.8 or more. Equal sets form a class
first, and only one document of each class goes on.

Order every set by one global order: shingles that occur in one class only come first, those that many classes have come last, by their
number, then by hash. So prefixes hold the shingles of common lines only where a document has little else. If sets of n and m shingles
link, they share a = ceil(0.8 max(n, m)) of them, so for any l up to a their first n - ceil(0.8 n) + l and m - ceil(0.8 m) + l shingles
share l. Each document picks its l: a longer prefix meets more documents but must share more shingles before a pair is verified. It
weighs the estimated sizes of the buckets that its prefix shingles lead to against the verifications they cause. A pair is
judged by the lesser l of the two, at which both prefixes hold.

Pairs of buckets of up to ``SMALL`` documents are counted and verified by joins. The documents of larger buckets are gathered by
families (documents that large buckets connect), cut into blocks, and each pair of blocks is one task that verifies its pairs and
returns a spanning forest of the links and how many links each document has, so copies of one text never become all their pairs.
A pair within a family is left to its blocks, so that each link is counted once.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import forget, join_groups, slices, table, unpacked, utf8, whole
from .components import components
from .exact_dedup import BLOCK_BITS, marked
from .hashing import mix, shingle_sets
from .packed import pack, unpack

WIDTH = 5
PERCENT = 80
MAX_MATCH = 4
SMALL = 32
BLOCK = 1_024
BLOCK_SHINGLES = 500_000
PART_SHINGLES = 2_000_000
# A task reads this many shingles of its documents before it sends them on
CHUNK_SHINGLES = 2_000_000
# In such a chunk, a shingle in more of them than this is passed on as repeated without its documents meeting in one task
LOCAL = 32
# Of the shingles that more than SMALL classes have, this many at most have a place of their own in the global order
COMMON = 500_000
# Of the filter of rows that are not alone in their class
BITS_PER_ROW = 32
MAX_BLOCKS = 1 << 14
# What verifying a pair costs, in bucket entries read
VERIFY_COST = 8
OUTPUT = ("n_shingles", "component_id", "n_links")


def _sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n, sig): size and 128-bit digest of each document's shingle set."""
    def body(batches):
        import hashlib

        import pyarrow as pa

        for batch in slices(batches):
            sets = shingle_sets(utf8(batch), WIDTH)
            sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(sig, pa.binary())],
                                             ["doc_id", "text_hash", "n", "sig"])

    return docs.mapInArrow(body, "doc_id bigint, text_hash bigint, n bigint, sig binary")


def _node(salt: int, doc_id: str = "doc_id") -> Column:
    return F.xxhash64(F.lit(salt), doc_id, "text_hash")


def _firsts(docs: DataFrame, sets: DataFrame, classes: DataFrame, salt: int) -> tuple[DataFrame, DataFrame]:
    """((node, text) of the first row of each class, once each; the stored filter that it reads).

    A row that is a class of its own is its first and passes straight through. Every row of a larger class sets a bit of a
    broadcast filter; only rows whose bit is set (a few others among them) are shuffled to find out which are first. Past its
    bound the filter lets more rows through to the shuffle and the result stays the same.
    """
    total, mates = classes.agg(F.sum("copies"), F.sum(F.when(F.col("copies") > 1, F.col("copies")))).first()
    blocks = min(max(-(-(mates or 0) * BITS_PER_ROW // BLOCK_BITS), 1), MAX_BLOCKS)
    place = F.pmod(F.col("node"), F.lit(blocks * BLOCK_BITS))
    placed = {"_block": F.floor(place / BLOCK_BITS).cast("int"), "_bit": place % BLOCK_BITS}
    mates = join_groups(sets.select("sig", _node(salt).alias("node")), classes.filter("copies > 1").select("sig", "copies"), "sig", "copies", total or 0, "inner")
    bits = materialize(mates.withColumns(placed).groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "jaccard_copies")
    rows = docs.filter("doc_id is not null").withColumn("node", _node(salt)).withColumns(placed).join(F.broadcast(bits), "_block", "left")
    rows = rows.withColumn("_maybe", F.coalesce(marked(F.col("_bit")), F.lit(False))).drop("_block", "_bit", "_bits")
    names = ["node", "doc_id", "text_hash"]
    first = rows.filter("_maybe").join(classes.select("node", F.col("rep").alias("doc_id"), "text_hash"), names, "left_semi").dropDuplicates(names)
    return rows.filter("not _maybe").select("node", "text").unionByName(first.select("node", "text")), bits


def _members(firsts: DataFrame, parts: int) -> DataFrame:
    """(node, n, first, tokens), stored, of the classes that may link: their size, their shingles that occur in another class too, in
    global order, and how many of those are in the prefix for l = 1.

    The shingles of a chunk of documents are sent to ``parts`` parts by ranges of their hash, where they meet those of other chunks;
    the repeated ones go back to their chunk. Both ways they travel as packed arrays, with places in the chunk's list of nodes;
    the list itself travels once.
    """
    def chunks(batches):
        held, many = [], 0
        for batch in slices(batches):
            sets = shingle_sets(utf8(batch), WIDTH)
            held += [(node, s) for node, s in zip(batch.column(0).to_pylist(), sets) if len(s)]
            many += sum(map(len, sets))
            if many >= CHUNK_SHINGLES:
                yield zip(*held)
                held, many = [], 0
        if held:
            yield zip(*held)

    def cut(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for nodes, sets in chunks(batches):
            nodes, sizes = np.array(nodes, np.int64), np.fromiter(map(len, sets), np.int64, len(sets))
            chunk = int.from_bytes(hashlib.blake2b(nodes.tobytes(), digest_size=8).digest(), "little", signed=True)
            hashes, who = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.uint32), sizes)
            order = np.argsort(hashes, kind="stable")
            hashes, who = hashes[order], who[order]
            begin = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
            size = np.diff(np.append(begin, len(hashes)))
            place = np.arange(len(hashes)) - np.repeat(begin, size)
            size = np.repeat(size, size)
            many = size > LOCAL
            part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)  # by range

            def rows(known, part, chosen):
                h, w, p = hashes[chosen], who[chosen], part[chosen]
                more = np.where(many & (place == 0) & (not known), size - 2, 0)[chosen].astype(np.uint32)  # that it stands for
                at = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1]))) if len(p) else []
                for a, b in zip(at, np.append(at[1:], len(p))):
                    yield int(p[a]), known, chunk, *_entries(h[a:b], w[a:b]), pack(more[a:b]) if more[a:b].any() else None, None, None

            found = list(rows(0, part, ~many | (place < 2)))
            if many.any():  # two of them tell the others that the shingle is repeated
                found += rows(1, np.full(len(hashes), (chunk + 1) % parts), many)
            found.append((chunk % parts, 0, chunk, None, None, None, pack(nodes), pack(sizes.astype(np.uint32))))
            columns = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[3:])],
                                             ["part", "known", "chunk", "hashes", "local", "more", "nodes", "sizes"])

    def meet(rows):
        import numpy as np
        import pandas as pd

        forget()
        lists, rows = rows[rows["nodes"].notna()], rows[rows["hashes"].notna()]
        out = [(c, None, None, n, s) for c, n, s in zip(lists["chunk"], lists["nodes"], lists["sizes"])]
        if len(rows):
            many, hashes, local = _all_entries(rows)
            known = np.repeat(rows["known"].to_numpy() > 0, many)
            stands = (~known).astype(np.int64)
            for end, n, more in zip(np.cumsum(many), many, rows["more"]):
                if more is not None:
                    stands[end - n:end] += unpack(more, np.uint32)
            source = np.repeat(np.arange(len(rows), dtype=np.int32), many)
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            same = hashes[1:] == hashes[:-1]
            begin = np.flatnonzero(np.concatenate(([True], ~same)))
            count = np.add.reduceat(stands[order], begin)
            often = np.flatnonzero(count > SMALL)
            often = np.sort(often[np.argsort(-count[often], kind="stable")[:2 * COMMON // parts + 1]])
            if len(often):
                out.append((None, *_entries(hashes[begin[often]], count[often]), None, None))
            twice = np.concatenate((same, [False])) | np.concatenate(([False], same)) | known[order]
            order, hashes = order[twice], hashes[twice]
            back = np.argsort(source[order], kind="stable")
            order, hashes = order[back], hashes[back]
            cut = np.searchsorted(source[order], np.arange(len(rows) + 1)).tolist()
            out += [(c, *_entries(hashes[a:b], local[order[a:b]]), None, None) for c, a, b in zip(rows["chunk"], cut, cut[1:]) if a < b]
        columns = list(zip(*out)) or [()] * 5
        return pd.DataFrame({"chunk": pd.array(columns[0], "Int64"), **dict(zip(("hashes", "local", "nodes", "sizes"), map(list, columns[1:])))})

    entries = "hashes binary, local binary, nodes binary, sizes binary"
    found = firsts.mapInArrow(cut, "part bigint, known int, chunk bigint, hashes binary, local binary, more binary, nodes binary, sizes binary") \
        .groupBy("part").applyInPandas(meet, f"chunk bigint, {entries}")
    found = materialize(found, "jaccard_repeated")
    common, often = _common(found.filter("chunk is null"))

    def gather(rows):
        import numpy as np
        import pandas as pd

        forget()
        (nodes, sizes), = rows.loc[rows["nodes"].notna(), ["nodes", "sizes"]].to_numpy()  # one list a chunk
        nodes, sizes = unpack(nodes, np.int64), unpack(sizes, np.uint32)
        rows = rows[rows["hashes"].notna()]
        if not len(rows):
            return pd.DataFrame(columns=["node", "n", "first", "tokens"], dtype=object)
        _, hashes, local = _all_entries(rows)
        at = np.minimum(np.searchsorted(common, hashes), max(len(common) - 1, 0))
        rank = np.where(common[at] == hashes, often[at], 0) if len(common) else np.zeros(len(hashes), np.int64)
        order = np.lexsort((hashes, rank, local))
        hashes, local = hashes[order].view(np.int64), local[order]
        once = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (local[1:] != local[:-1])))
        hashes, local = hashes[once], local[once]
        at = np.flatnonzero(np.concatenate(([True], local[1:] != local[:-1])))
        n, many = sizes[local[at]].astype(np.int64), np.diff(np.append(at, len(local)))
        first = n - -(-n * PERCENT // 100) + 1 - (n - many)
        keep = np.flatnonzero(first > 0)
        return pd.DataFrame({"node": nodes[local[at][keep]], "n": n[keep], "first": first[keep].astype(np.int32),
                             "tokens": pd.Series([hashes[at[k]:at[k] + many[k]] for k in keep], dtype=object)})

    members = found.filter("chunk is not null").groupBy("chunk").applyInPandas(gather, "node bigint, n bigint, first int, tokens array<bigint>")
    members = materialize(members, "jaccard_members")
    discard(found)
    return members


def _common(rows: DataFrame):
    """(hashes, ascending, how many classes have each) of the shingles that most classes have: ``COMMON`` of them or fewer."""
    import numpy as np

    found = [_read_entries(r["hashes"], r["local"]) for r in rows.select("hashes", "local").collect()]
    hashes, count = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    most = np.lexsort((hashes, -count.astype(np.int64)))[:COMMON]
    most = most[np.argsort(hashes[most])]
    return hashes[most], count[most].astype(np.int64)


def _entries(hashes, local) -> tuple[bytes, bytes]:
    """Ascending hashes and a small number for each, as bytes."""
    import numpy as np

    return pack(np.diff(hashes, prepend=np.uint64(0))), pack(np.minimum(local, 0xFFFFFFFF).astype(np.uint32))


def _read_entries(hashes: bytes, local: bytes):
    import numpy as np

    return np.cumsum(unpack(hashes, np.uint64), dtype=np.uint64), unpack(local, np.uint32)


def _all_entries(rows):
    """(number of entries of each row, hashes, places) of all rows; what they are read into goes on return."""
    import numpy as np

    found = [_read_entries(*r) for r in zip(rows["hashes"], rows["local"])]
    return [len(f[0]) for f in found], *(np.concatenate(c) for c in zip(*found))


def _candidates(docs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, members): members have the classes that may link, with their repeated shingles in global order."""
    rows = sets.filter("n > 0").groupBy("sig").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n").alias("n"), F.count("*").alias("copies"))
    rows = rows.select("sig", F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("text_hash"), "n", "copies")
    for salt in count():
        classes = materialize(rows.withColumn("node", _node(salt, "rep")), "jaccard_classes")
        who = F.struct("rep", "text_hash")
        if classes.groupBy("node").agg(F.min(who).alias("a"), F.max(who).alias("b")).filter("a <> b").isEmpty():
            break
        discard(classes)  # two classes of one number: all get other ones
    parts = int(classes.agg(F.sum("n")).first()[0] or 0) // PART_SHINGLES + 1
    firsts, bits = _firsts(docs, sets, classes, salt)
    members = _members(firsts, max(parts, docs.sparkSession.sparkContext.defaultParallelism))
    discard(bits)
    return classes, members


def _prefixes(members: DataFrame) -> DataFrame:
    """(hash, node, n, level, match, bucket), stored: the prefix entries of each member at the l (``match``) that it picks."""
    most = F.least(F.lit(MAX_MATCH), F.ceil(F.col("n") * PERCENT / 100)).cast("int")
    size = F.least(F.col("first") + most - 1, F.size("tokens"))
    entries = members.select("node", "n", "first", most.alias("most"), F.posexplode(F.slice("tokens", F.lit(1), size)).alias("place", "hash")) \
        .withColumn("level", F.greatest(F.col("place") - F.col("first") + 2, F.lit(1)))
    entries = materialize(entries, "jaccard_entries")
    buckets = entries.groupBy("hash").agg(F.count("*").alias("bucket")).filter("bucket > 1")
    met = materialize(join_groups(entries, buckets.withColumn("size", F.col("bucket")), "hash", "size", entries.count(), "inner"), "jaccard_met")
    # by l: the entries its buckets hold, of which about one in l reaches verification
    costs = [F.sum(F.when(F.col("level") <= match, F.col("bucket") - 1)) * (1 + F.lit(VERIFY_COST) / match) for match in range(1, MAX_MATCH + 1)]
    costs = F.array(*[F.when(F.first("most") >= match, F.struct(F.coalesce(c, F.lit(0.0)).alias("cost"), F.lit(match).alias("match"))) for match, c in enumerate(costs, 1)])
    picked = met.groupBy("node").agg(F.array_min(F.filter(costs, lambda c: c.isNotNull()))["match"].alias("match"))
    prefixes = met.join(picked, "node").filter("level <= match").select("hash", "node", "n", "level", "match", "bucket")
    prefixes = materialize(prefixes, "jaccard_prefixes")
    discard(entries, met)
    return prefixes


def _near(a: str, b: str):
    """Whether sets of sizes a and b are near enough in size to link."""
    return (F.col(a) * 100 >= F.col(b) * PERCENT) & (F.col(b) * 100 >= F.col(a) * PERCENT)


def _small_links(entries: DataFrame, members: DataFrame, families: DataFrame) -> DataFrame:
    """(a, b), once each and stored, of the links whose documents share prefix shingles in small buckets and are not of one family."""
    pairs = entries.alias("l").join(entries.alias("r"), (F.col("l.hash") == F.col("r.hash")) & (F.col("l.node") < F.col("r.node")) & _near("l.n", "r.n")) \
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.least("l.match", "r.match").alias("match"), F.greatest("l.level", "r.level").alias("level"))
    pairs = pairs.filter("level <= match").groupBy("a", "b", "match").count().filter("count >= match").select("a", "b")
    fa, fb = (families.select(F.col("node").alias(k), F.col("family").alias("family" + k)) for k in "ab")
    pairs = pairs.join(fa, "a", "left").join(fb, "b", "left").filter("familya is null or familyb is null or familya <> familyb").select("a", "b")
    one, two = (members.select(F.col("node").alias(k), F.col("n").alias("n" + k), F.col("tokens").alias("tokens" + k)) for k in "ab")
    pairs = materialize(pairs, "jaccard_pairs")
    both = pairs.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("tokensa", "tokensb")))
    small = materialize(both.filter(F.col("shared") * 100 >= PERCENT * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b"), "jaccard_small")
    discard(pairs)
    return small


def _families(entries: DataFrame) -> DataFrame:
    """(node, family) of the documents that large buckets connect."""
    buckets = entries.groupBy("hash").agg(F.min("node").alias("b"), F.count("*").alias("size"))
    edges = join_groups(entries.select("hash", F.col("node").alias("a")), buckets, "hash", "size", entries.count()).select("a", "b")
    return components(edges).withColumnRenamed("component", "family")


def _large_links(families: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """The links within families, stored: (a, b, null), a spanning forest of them, and (a, null, links), from each pair of blocks the
    documents that a links with there, copies included."""
    rows = families.join(classes.select("node", "copies"), "node").join(members.select("node", "n", "tokens"), "node")
    rows = materialize(rows, "jaccard_families")
    blocks = rows.groupBy("family").agg(F.count("*").alias("size"), F.ceil(F.greatest(F.count("*") / BLOCK, F.sum(F.size("tokens")) / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    placed = join_groups(rows, blocks, "family", "size", rows.count()).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    tiles = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("family", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "n", "copies", "tokens")

    def verify(rows):
        import numpy as np
        import pandas as pd

        forget()
        node, n, block, copies = (rows[c].to_numpy() for c in ("node", "n", "block", "copies"))
        low, high = int(rows["low"].iloc[0]), int(rows["high"].iloc[0])
        sizes = np.fromiter(map(len, rows["tokens"]), np.int64, len(rows))
        flat = np.concatenate(list(rows["tokens"]))
        owner = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(flat, kind="stable")
        owner, value = owner[order], flat[order]  # the documents of each shingle, ascending
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        rank = np.empty(len(flat), np.int64)
        rank[order] = np.cumsum(np.concatenate(([False], value[1:] != value[:-1])))
        last = np.append(first[1:], len(value))
        begin = np.cumsum(sizes) - sizes
        root = list(range(len(rows)))

        def find(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        edges, links = [], np.zeros(len(rows), np.int64)
        for k in np.flatnonzero(block == low).tolist():
            mine = rank[begin[k]:begin[k] + sizes[k]]
            shared = np.bincount(np.concatenate([owner[a:b] for a, b in zip(first[mine].tolist(), last[mine].tolist())]), minlength=len(rows))
            link = (shared * 100 >= PERCENT * (n + n[k] - shared)) & ((block == high) if low != high else (np.arange(len(rows)) > k))
            links[k] += copies[link].sum()
            links[link] += copies[k]
            for m in np.flatnonzero(link).tolist():
                if (x := find(k)) != (y := find(m)):
                    root[max(x, y)] = min(x, y)
                    edges.append((node[k], node[m]))
        some = np.flatnonzero(links)
        a, b = zip(*edges) if edges else ((), ())
        return pd.DataFrame({"a": np.concatenate((np.array(a, np.int64), node[some])), "b": pd.array([*b, *[None] * len(some)], "Int64"),
                             "links": pd.array([*[None] * len(edges), *links[some].tolist()], "Int64")})

    # dealt by block pair: dealt by family alone, a large family's pairs would be one task
    links = tiles.repartition("family", "low", "high").groupBy("family", "low", "high").applyInPandas(verify, "a bigint, b bigint, links bigint")
    links = materialize(links, "jaccard_large")
    discard(rows)
    return links


def jaccard_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, component, n_links): one row for each row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links lead to, the document's own included; n_links is the number of other rows that
    the row itself links with. text_hash is xxhash64 of the text; component names the component where several have the same
    component_id, and is null for a row that links with nothing by itself: one without words or doc_id. Words are compared with A-Z
    lower-cased. A document of fewer than five words is one shingle of all of them; one without words, empty or null,
    links with nothing. Rows with equal sets, repeated rows among them, are linked; rows with the same doc_id are documents of their own. An
    empty table gives an empty result. A null doc_id is passed on and its row links with nothing.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("text_hash"))
    sets = materialize(_sets(docs), "jaccard_sets")
    classes, members = _candidates(docs, sets.filter("doc_id is not null"))
    entries = _prefixes(members)
    families = materialize(_families(entries.filter(F.col("bucket") > SMALL)), "jaccard_family")
    small = _small_links(entries.filter(F.col("bucket") <= SMALL), members, families)
    large = _large_links(families, members, classes)
    discard(members, entries, families)
    joined = components(small.unionByName(large.filter("b is not null").select("a", "b"))).join(classes.select("node", "rep"), "node")
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    linked = joined.join(least, "component").select("node", "component", "component_id")
    both = small.unionByName(small.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(classes.select(F.col("node").alias("b"), F.col("copies").alias("links")), "b").select("a", "links") \
        .unionByName(large.filter("b is null").select("a", "links")).groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    found = classes.join(linked, "node", "left").join(counts, "node", "left") \
        .select("sig", "copies", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = join_groups(sets, found, "sig", "copies", sets.count())
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    links = F.when(F.col("doc_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0)
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component"), links.cast("bigint").alias("n_links"))


def jaccard_links(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of ``jaccard_rows``."""
    return jaccard_rows(docs).select("doc_id", *OUTPUT)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``jaccard_links``."""
    return jaccard_links(docs).drop("n_links")


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component one row with its smallest doc_id stays, and rows without words or doc_id."""
    found = jaccard_rows(docs).filter("component is not null")
    best = F.min(F.struct("doc_id", "text_hash")).alias("best")
    first = found.groupBy("component").agg(best).select("best.doc_id", "best.text_hash")
    # rows that agree in both are of one component
    rows = whole(docs, F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    kept = rows.join(first, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text_hash"])
    loose = F.col("doc_id").isNull() | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.select(*unpacked(docs)).unionByName(docs.filter(loose))
