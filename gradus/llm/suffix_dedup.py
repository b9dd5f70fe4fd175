"""Operator 1: removal of long repeated byte strings by longest previous factors.

Every string of `length` bytes holds at least one anchor: the leftmost smallest of its hashed k-grams, a choice that
depends on the string alone. So equal strings meet under the same anchor, and only anchors that occur in several
places need a look at the text.

1. One pass over the texts emits, for each anchor, the segment of all strings it stands for. Equal segments of a block
   are reduced to the first at once, so a hot passage leaves one row a block.
2. Grouped by anchor, a segment equal to an earlier one is a repeat. Segments that share an anchor but differ are
   compared as text: in suffix order, the previous and next smaller positions give the longest previous factor.
3. An anchor with very many different segments is split by the bytes around it (a narrower range of starts, and the
   core that those starts share) until equal strings have equal rows, so no group grows with the corpus. Anchors that
   blocks of text hold often (a line under other surroundings in every document) are found by a pass before, at most
   LISTED of them. They are never brought together: their segments are dealt one by one and go to the split at once.
   The list only chooses the way, the result is the same without it. An anchor that is not listed holds at most OFTEN segments
   a block, or one part in LISTED of what the listed ones hold.

Rows without doc_id are left out. A null text is empty. Rows that share a doc_id and text stand at the same positions: they
don't repeat each other. Rows that share a doc_id with other texts are documents one after the other, in the order of a hash of
the text. Texts shorter than `length` and empty tables give no spans. Other columns pass through; those named like a
column that is added are replaced.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import numbered, stored
from .spans import U, mix, prefix_sums, powers, text_blocks

GROUP = 4096  #: different segments of an anchor that are compared in one task; beyond, the anchor is split
OFTEN = 16  #: different segments of an anchor in a block of text from which on it is counted before
WINDOW = 2 << 20  #: bytes of a text whose anchors are looked for at a time, so that memory does not follow the longest text
LISTED = 10_000  #: anchors that are split without being brought together, at most; the list goes through the driver


def _anchors(buf: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """Of each anchor: hash, hash of its segment, first start, segment length, anchor's place in it, text number."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.astype(U), none.astype(U), none, none, none, none
    sums, inverse = prefix_sums(buf), powers(n + 1)[1]
    gram = mix((sums[k:] - sums[:-k]) * inverse[: n - k + 1])
    value, at, width, window = gram, np.arange(len(gram), dtype=np.int32), 1, length - k + 1
    while width < window:
        step = min(width, window - width)
        left = value[:-step] <= value[step:]
        at = np.where(left, at[:-step], at[step:])
        value = np.where(left, value[:-step], value[step:])
        width += step
    valid = np.ones(len(at), bool)
    for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        valid[max(s, e - length + 1) : e] = False
    start = np.flatnonzero(valid)
    if not len(start):
        return none.astype(U), none.astype(U), none, none, none, none
    anchor = at[start].astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    lo, anchor = start[first], anchor[first]
    size = start[np.append(first[1:], len(start)) - 1] - lo + length
    signature = mix((sums[lo + size] - sums[lo]) * inverse[lo] + (size * 4096 + anchor - lo).astype(U) * U(0xD6E8FEB86659FD93))
    return gram[anchor], signature, lo, size, anchor - lo, np.searchsorted(offsets, lo, "right") - 1


def _block_anchors(buf: np.ndarray, offsets: np.ndarray, length: int, k: int, window: int):
    """_anchors() of a block, `window` starts at a time: a string's anchor depends on the string alone. A segment that a window ends in
    is told in two parts, which meet equal strings under the same anchor as any other segments do."""
    if len(buf) < window + length:
        return _anchors(buf, offsets, length, k)
    found = []
    for at in range(0, len(buf) - length + 1, window):
        part = buf[at : at + window + length - 1]
        key, sig, lo, size, off, text = _anchors(part, np.clip(offsets - at, 0, len(part)), length, k)
        found.append((key, sig, lo + at, size.astype(np.int32), off.astype(np.int32), text))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Overlapping or touching ranges of a document as one; doc, lo sorted."""
    if not len(doc):
        return doc, lo, hi
    span = int(hi.max()) + 2
    number = np.cumsum(np.append(True, doc[1:] != doc[:-1])).astype(np.int64) * span
    far = np.maximum.accumulate(hi + number)
    new = np.append(True, (lo + number)[1:] > far[:-1])
    first = np.flatnonzero(new)
    return doc[first], lo[first], (far - number)[np.append(first[1:], len(doc)) - 1]


def _often(length: int, k: int, often: int, window: int):
    """Anchors with more than `often` different segments in a block, and how many."""

    def run(batches):
        for _, buf, offsets in text_blocks(batches, "doc_id", "text"):
            key, sig, *_ = _block_anchors(buf, offsets, length, k, window)
            keys = np.sort(key)
            keys = np.unique(keys[often:][keys[often:] == keys[: len(keys) - often]])  # as many segments, equal ones included
            row = np.flatnonzero(np.isin(key, keys))
            row = row[np.lexsort((sig[row], key[row]))]
            key, sig = key[row], sig[row]
            new = np.ones(len(row), bool)
            new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
            keys, n = np.unique(key[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys[n > often].view(np.int64)), pa.array(n[n > often].astype(np.int64))], names=["akey", "n"])

    return run


def frequent_anchors(docs: DataFrame, length: int, gram: int, group: int, often: int, window: int = WINDOW) -> np.ndarray:
    """The anchors of the most segments, more than `group`, among those that some block holds more than `often` times; LISTED at most."""
    counts = docs.mapInArrow(_often(length, gram, often, window), "akey long, n long").groupBy("akey").agg(F.sum("n").alias("n"))
    listed = counts.where(F.col("n") > group).orderBy(F.desc("n"), "akey").limit(LISTED)
    return np.sort(np.array([r["akey"] for r in listed.collect()], np.int64).view(U))


def _emit_anchors(length: int, k: int, frequent: np.ndarray, window: int):
    """akey: what the segment is dealt by, its anchor or, if that is frequent, both. pack: start, whether frequent, length, place."""
    names = ["akey", "sig", "doc_id", "pack"]

    def run(batches):
        for rows, buf, offsets in text_blocks(batches, "doc_id", "text"):
            ids = rows.column("doc_id").to_numpy(zero_copy_only=False)
            key, sig, lo, size, off, text = _block_anchors(buf, offsets, length, k, window)
            doc, lo = ids[text], lo - offsets[text]
            order = np.lexsort((lo, doc, sig, key))
            key, sig, lo, size, off, doc = (x[order] for x in (key, sig, lo, size, off, doc))
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])
            head = np.flatnonzero(new)
            head = np.repeat(head, np.diff(np.append(head, len(key))))
            later = (doc != doc[head]) | (lo != lo[head])
            d, a, b = doc[later], lo[later], (lo + size)[later]
            order = np.lexsort((a, d))
            d, a, b = _merged(d[order], a[order], b[order])
            listed = np.isin(key, frequent)
            key = np.where(listed, mix(key ^ sig), key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([key[new].view(np.int64), mix(d.astype(U) * U(2654435761) + a.astype(U)).view(np.int64)])), pa.array(np.concatenate([sig[new].view(np.int64), b])), pa.array(np.concatenate([doc[new], d]).astype(np.int64)), pa.array(np.concatenate([(lo * (1 << 25) + listed * (1 << 24) + size * (1 << 12) + off)[new], -a - 1]))], names=names
            )

    return run


def previous_smaller(value: np.ndarray) -> np.ndarray:
    """For each place, the nearest place before it with a smaller value, or -1; by pointer jumping."""
    before = np.arange(-1, len(value) - 1)
    active = np.flatnonzero(before >= 0)
    while len(active):
        active = active[value[before[active]] >= value[active]]
        before[active] = before[before[active]]
        active = active[before[active] >= 0]
    return before


def previous_factors(group: np.ndarray, data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Longest previous factor, up to length, of the strings at starts (ascending in text order) among those of their group.

    Strings are put in suffix order; the longest match with an earlier one is that with the previous or the next
    smaller position there.
    """
    n, words = len(starts), (length + 7) // 8
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    columns = [np.ascontiguousarray(eight[starts + min(8 * i, max(0, length - 8))]).view(">u8").ravel().astype(U) for i in range(words)]
    order = np.lexsort((starts, *columns[::-1], group))
    found = np.zeros(n, np.int64)
    for side in (order, order[::-1]):
        smaller = previous_smaller(side)
        mine, other = side[smaller >= 0], side[smaller[smaller >= 0]]
        same = group[mine] == group[other]
        mine, other = mine[same], other[same]
        equal, open_ = np.zeros(len(mine), np.int64), np.ones(len(mine), bool)
        for i, column in enumerate(columns):
            differ = column[mine] ^ column[other]
            bits = np.frexp((differ >> U(32)).astype(float))[1] + 32
            low = np.frexp((differ & U(0xFFFFFFFF)).astype(float))[1]
            matched = np.where(differ == 0, 8, (64 - np.where(differ >> U(32) > 0, bits, low)) // 8)
            equal = np.where(open_, min(8 * i, max(0, length - 8)) + matched, equal)
            open_ &= differ == 0
        found[mine] = np.maximum(found[mine], np.minimum(equal, length))
    return found


def _factor_spans(length: int):
    """Rows (gkey, doc_id, s, seg), sorted by gkey, doc_id, s -> covered ranges (doc_id, s, e). Whole groups are taken up to about 1 MB."""

    def solve(parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks()
        seg = rows.column("seg").chunk(0)
        offsets = np.frombuffer(seg.buffers()[1], np.int32)[seg.offset : seg.offset + len(seg) + 1].astype(np.int64)
        data = np.frombuffer(seg.buffers()[2], np.uint8)
        group, doc, at = (rows.column(c).to_numpy() for c in ("gkey", "doc_id", "s"))
        count = np.diff(offsets) - length + 1
        row = np.repeat(np.arange(len(seg)), count)
        inner = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        hit = previous_factors(group[row], data, offsets[row] + inner, length) >= length
        d, s = doc[row[hit]], at[row[hit]] + inner[hit]
        order = np.lexsort((s, d))
        d, s, e = _merged(d[order], s[order], s[order] + length)
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(s), pa.array(e)], names=["doc_id", "s", "e"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            group, i = batch.column("gkey").to_numpy(), 0
            cuts = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
            if held and held[-1].column("gkey")[-1].as_py() != group[0] and size > 1 << 20:
                yield solve(held)
                held, size = [], 0
            mean = max(1, batch.nbytes // batch.num_rows)
            for cut in cuts.tolist():
                if size + (cut - i) * mean > 1 << 20 or cut == len(group):
                    held.append(batch.slice(i, cut - i))
                    size += (cut - i) * mean
                    i = cut
                    if cut < len(group):
                        yield solve(held)
                        held, size = [], 0
        if held:
            yield solve(held)

    return run


def _by_factors(segments: DataFrame, length: int) -> DataFrame:
    ordered = segments.select("gkey", "doc_id", "s", "seg").repartition("gkey").sortWithinPartitions("gkey", "doc_id", "s")
    return ordered.mapInArrow(_factor_spans(length), "doc_id long, s long, e long")


def _ranked(rows: DataFrame, key: str, place: list[str]) -> DataFrame:
    """is_first: no equal segment of the group stands earlier; variants: the group's different segments."""
    same = Window.partitionBy(key, "sig").orderBy(*place)
    rows = rows.withColumn("rn", F.row_number().over(same)).withColumn("head", F.first(F.struct(*place)).over(same))
    rows = rows.withColumn("is_first", F.struct(*place) == F.col("head")).drop("head")
    return rows.withColumn("variants", F.sum((F.col("rn") == 1).cast("long")).over(Window.partitionBy(key)))


def _split_ranked(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces that stand earlier in the group, and the first of each with variants. By sums, as one piece may stand in all documents."""
    head = F.min(F.struct("doc_id", "s", "off", "seg")).alias("head")
    heads = stored(pieces.groupBy("gkey", "sig").agg(head), "heads")
    variants = heads.groupBy("gkey").agg(F.count(F.lit(1)).alias("variants"))
    places = heads.select("gkey", "sig", F.col("head.doc_id").alias("first_id"), F.col("head.s").alias("first_s"))
    again = pieces.select("gkey", "sig", "doc_id", "s", F.octet_length("seg").alias("n")).join(places, ["gkey", "sig"])
    again = again.where("doc_id <> first_id or s <> first_s").select("doc_id", "s", (F.col("s") + F.col("n")).alias("e"))
    return again, stored(heads.join(variants.where("variants > 1"), "gkey").select("gkey", "variants", "head.*"), "firsts")


def _pieces(wide: DataFrame, length: int, width: int) -> DataFrame:
    """Each segment cut into ranges of `width` starts, counted from the anchor; a range is keyed by the bytes that its starts share."""
    j0, j1 = f"floor((off - (octet_length(seg) - {length})) / {width})", f"floor(off / {width})"
    lo, hi = f"greatest(0, off - {width} * j - {width - 1})", f"least(octet_length(seg) - {length}, off - {width} * j)"
    cut = wide.withColumn("j", F.explode(F.expr(f"sequence(cast({j0} as int), cast({j1} as int))"))).withColumn("a", F.expr(lo)).withColumn("b", F.expr(hi))
    cut = cut.withColumn("core", F.expr(f"substring(seg, cast(off - {width} * j as int) + 1, {length - width + 1})"))
    return cut.select(F.expr("xxhash64(gkey, j, core)").alias("gkey"), "doc_id", F.expr("s + a").alias("s"), F.expr("cast(off - a as int)").alias("off"), F.expr(f"substring(seg, cast(a as int) + 1, cast(b - a as int) + {length})").alias("seg")).withColumn("sig", F.xxhash64("seg", "off", F.lit(7)))


def repeated_spans(docs: DataFrame, length: int = 100, gram: int = 32, group: int = GROUP, often: int = OFTEN, window: int = WINDOW) -> DataFrame:
    """(doc_id, s, e): the maximal ranges of bytes covered by strings of `length` bytes that also start earlier. A doc_id has one text."""
    if not 8 <= gram < length < 2048 or group < 1:
        raise ValueError("8 <= gram < length < 2048 and group >= 1 are needed")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    frequent = frequent_anchors(docs, length, gram, group, often, window)
    anchors = docs.mapInArrow(_emit_anchors(length, gram, frequent, window), "akey long, sig long, doc_id long, pack long").repartition("akey")
    ranked = _ranked(anchors, "akey", ["doc_id", "pack"])
    ranked = ranked.withColumn("variants", F.expr(f"if(pack >= 0 and (shiftright(pack, 24) & 1) = 1, {group + 1}L, variants)"))
    kept = stored(ranked.where("pack < 0 or not is_first or (rn = 1 and variants > 1)"), "anchors")
    size, at = F.expr("cast(shiftright(pack, 12) & 4095 as int)"), F.shiftright("pack", 25)
    whole = kept.where("pack < 0 or not is_first").select("doc_id", F.expr("if(pack < 0, -pack - 1, shiftright(pack, 25))").alias("s"), F.when(F.col("pack") < 0, F.col("sig")).otherwise(at + size).alias("e"))
    asked = kept.where("pack >= 0 and is_first").groupBy("doc_id").agg(F.collect_list(F.struct(F.expr("if((shiftright(pack, 24) & 1) = 1, 0L, akey)").alias("akey"), "variants", at.cast("int").alias("s"), size.alias("n"), F.expr("cast(pack & 4095 as int)").alias("off"))).alias("asked"))
    seg = "substring(b, r.s + 1, r.n) as seg"
    cut = f"transform(asked, r -> struct(r.akey as gkey, r.variants as variants, cast(r.s as long) as s, r.off as off, {seg}))"
    cut = _once("cast(text as binary)", cut)
    segments = docs.join(asked, "doc_id").select("doc_id", F.explode(F.expr(cut)).alias("r")).select("doc_id", "r.*")
    segments = stored(segments, "segments")
    found = [whole, _by_factors(segments.where(F.col("variants") <= group), length)]
    hot = segments.where(F.col("variants") > group)
    for width in (8, 1):
        again, left = _split_ranked(_pieces(hot, length, width))
        found.append(again)
        if width > 1:
            found.append(_by_factors(left.where(F.col("variants") <= group), length))
            hot = left.where(F.col("variants") > group)
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    by = Window.partitionBy("doc_id").orderBy("s", "e")
    islands = every.withColumn("before", F.max("e").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    islands = islands.withColumn("island", F.sum(F.expr("if(before is null or s > before, 1, 0)")).over(by))
    return islands.groupBy("doc_id", "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def _once(data: str, body: str) -> str:
    """SQL: body, where b stands for the bytes `data`. A column named inside a lambda is copied out of its row for every element, in time
    quadratic in the elements of a long text; b is copied once."""
    return f"transform(array({data}), b -> {body})[0]"


def _at_borders(spans: str, data: str) -> str:
    """SQL: spans without the bytes of characters that they cover in part."""
    inner = lambda at: f"hex(substring(b, cast({at} as int) + 1, 1)) between '80' and 'BF'"
    later = "x.s + " + f"if({inner('x.s')}, if({inner('x.s + 1')}, if({inner('x.s + 2')}, 3, 2), 1), 0)"
    sooner = "x.e - " + f"if({inner('x.e')}, if({inner('x.e - 1')}, if({inner('x.e - 2')}, 3, 2), 1), 0)"
    return _once(data, f"filter(transform({spans}, x -> struct({later} as s, {sooner} as e)), x -> x.s < x.e)")


def remove_repeats(
    docs: DataFrame, length: int = 100, gram: int = 32, group: int = GROUP, whole_characters: bool = False, often: int = OFTEN, window: int = WINDOW
) -> DataFrame:
    """docs with n_bytes, n_removed, n_spans and kept: the bytes left, as binary. A span may begin or end inside a character; with
    whole_characters such a character stays, and kept is valid UTF-8."""
    own = [c for c in docs.columns if c not in ("kept", "n_bytes", "n_spans", "n_removed")]
    whole = docs.where("doc_id is not null").withColumn("doc_id", F.col("doc_id").cast("long")).select("doc_id", "text", F.struct(*[c for c in own if c != "text"]).alias("row"))
    rows, _ = numbered(whole)  # the text travels once, all else beside it
    spans = repeated_spans(rows, length, gram, group, often, window).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))
    out = rows.join(spans, "doc_id", "left").withColumn("bytes", F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    if whole_characters:
        out = out.withColumn("spans", F.expr(_at_borders("spans", "bytes")))
    gaps = "filter(zip_with(array_insert(spans.e, 1, 0L), array_append(spans.s, cast(octet_length(bytes) as long)), (a, b) -> struct(cast(a as int) as a, cast(b - a as int) as n)), g -> g.n > 0)"
    parts = _once("bytes", f"transform({gaps}, g -> cast(substring(b, g.a + 1, g.n) as string))")  # joined once, as strings of any bytes
    kept = F.expr(f"if(spans is null, bytes, cast(array_join({parts}, '') as binary))").alias("kept")
    own = [F.col(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in own]
    n_spans = F.expr("cast(if(spans is null, 0, size(spans)) as long)").alias("n_spans")
    n_removed = F.expr("if(spans is null, 0L, aggregate(spans, 0L, (n, x) -> n + x.e - x.s))").alias("n_removed")
    return out.select(*own, F.octet_length("bytes").cast("long").alias("n_bytes"), n_spans, kept, n_removed)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
