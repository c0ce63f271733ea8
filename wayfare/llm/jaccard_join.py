"""Similarity join of texts on word n-grams (Jaccard, exact).

Rare-first prefix filtering: the n-grams of a text are ordered by how rare
their hash bucket is in the whole corpus; two texts whose Jaccard similarity
reaches the threshold must share one of the first few.  Texts meet on those
prefix n-grams, under a length and a positional filter; a suffix filter bounds
their overlap by small counts of the sets' parts; each pair that is left is
verified once on its whole n-gram sets.

Equal sets are one class and meet as one.  Within the list of texts that share
a prefix n-gram, all texts are first compared with the one that holds it
earliest (a star); the list is searched for further pairs only between texts
that these links leave in different components, and a long list by what each of
its texts has different from the set that most of them share.  No link that
joins two components is lost, and a large group of near copies, or of texts that
just miss the threshold, costs stars, not all its pairs.  That shortcut is for components only; ``jaccard_links`` looks through
every list whole and returns all links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import wordscan as ws
from .components import component_stars
from .staging import stage, text_digest, without

SLICE_BYTES = 1 << 20    # text that is cut into n-grams at a time
FREQUENCY_BITS = 20      # hash buckets of the corpus-wide n-gram counts: 2**20
FREQUENCY_SLICES = 256   # the counts travel in so many slices
CANDIDATE_BITS = 26      # bits of the candidate filter (8 MB)
PARTS = 128              # parts of the hash range that the suffix filter counts in
HOT_SHARE = 100_000      # an n-gram is hot if its bucket has over one in so many of all n-grams
SALTS = 64               # a hot n-gram's list is looked through in so many parts
FAMILY_CLASSES = 32      # a longer list with several components is compared by what its texts differ in
FAMILY_COST = 1.0        # if it has more pairs than so many times its n-grams
FAMILY_SAMPLE = 33       # classes of a family (under 256) that tell what most of them share,
FAMILY_GRAMS = 1 << 21   # and n-grams of them, but one whole set
LIST_CLASSES = 1000      # classes of a list that a part compares with all of it, where all links are wanted


def _sets(batch: pa.RecordBatch, text_at: int, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct n-gram hashes) of a batch."""
    for row, end, data, offsets in ws.text_slices(batch.column(text_at), SLICE_BYTES):
        starts, ends, word_at = ws.find_words(data, offsets, ws.SPACE_SEPARATED)
        words = ws.hash_words(data, starts, ends)
        for k in range(end - row):
            yield row + k, np.unique(ws.ngram_hashes(words[word_at[k]:word_at[k + 1]], n))


def _digest(grams: np.ndarray) -> tuple[int, int]:
    both = np.frombuffer(hashlib.blake2b(grams.tobytes(), digest_size=16).digest(), np.int64)
    return int(both[0]), int(both[1])


def _bucket(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def _parts(grams: np.ndarray) -> bytes:
    """How many n-grams lie in each of ``PARTS`` equal parts of the hash range; 255 means at least that."""
    own = np.bincount((grams >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=PARTS)
    return np.minimum(own, 255).astype(np.uint8).tobytes()


def _packed(counts: np.ndarray) -> bytes:
    """Counts in as few bytes as they need: few of them one by one, many as an array."""
    at = np.flatnonzero(counts)
    if not len(at):
        return b""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * w)
    if len(at) * (width + 2) < len(counts) * width:
        return bytes([width, 1]) + at.astype("<u2").tobytes() + counts[at].astype(f"<u{width}").tobytes()
    return bytes([width, 0]) + counts.astype(f"<u{width}").tobytes()


def _add_packed(total: np.ndarray, packed: bytes) -> None:
    width, sparse = packed[0], packed[1]
    if sparse:
        size = (len(packed) - 2) // (width + 2)
        total[np.frombuffer(packed, "<u2", size, 2)] += np.frombuffer(packed, f"<u{width}", size, 2 + 2 * size).astype(
            np.int64)
    else:
        total += np.frombuffer(packed, f"<u{width}", offset=2).astype(np.int64)


def _survey(docs: DataFrame, n: int) -> DataFrame:
    """One scan: a row per text (set size, digest, sizes of parts), and n-gram counts by bucket."""
    schema = (f"doc_id {docs.schema[0].dataType.simpleString()}, n int, hi long, lo long, parts binary, "
              "slice int, counts binary")
    width = (1 << FREQUENCY_BITS) // FREQUENCY_SLICES

    def scan(batches):
        counts = np.zeros(1 << FREQUENCY_BITS, np.int64)
        for batch in batches:
            sizes, his, los, cuts = [], [], [], []
            for _, grams in _sets(batch, 1, n):
                hi, lo = _digest(grams)
                sizes.append(len(grams))
                cuts.append(_parts(grams))
                his.append(hi)
                los.append(lo)
                np.add.at(counts, _bucket(grams), 1)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(his, pa.int64()),
                 pa.array(los, pa.int64()), pa.array(cuts, pa.binary()), pa.nulls(rows, pa.int32()),
                 pa.nulls(rows, pa.binary())],
                names=["doc_id", "n", "hi", "lo", "parts", "slice", "counts"])
        parts = [(s, _packed(counts[s * width:(s + 1) * width])) for s in range(FREQUENCY_SLICES)]
        parts = [(s, p) for s, p in parts if p]
        if parts:
            rows = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(rows, batch.schema.field(0).type), pa.nulls(rows, pa.int32()),
                 pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()),
                 pa.array([s for s, _ in parts], pa.int32()), pa.array([p for _, p in parts], pa.binary())],
                names=["doc_id", "n", "hi", "lo", "parts", "slice", "counts"])

    return docs.mapInArrow(scan, schema)


def _frequencies(survey: DataFrame) -> np.ndarray:
    """Corpus-wide n-gram count of each bucket; the result has a fixed size."""
    width = (1 << FREQUENCY_BITS) // FREQUENCY_SLICES

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for s, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _add_packed(sums.setdefault(s, np.zeros(width, np.int64)), packed)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums.keys(), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                names=["slice", "counts"])

    slices = survey.filter("slice is not null").select("slice", "counts")
    total = np.zeros((FREQUENCY_SLICES, width), np.int64)
    for row in slices.repartition("slice").mapInArrow(add, "slice int, counts binary").collect():
        total[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return total.reshape(-1)


def _prefixes(docs: DataFrame, n: int, percent: int, counts: np.ndarray) -> DataFrame:
    """(token, class, size, position, salt) of the n-grams in each text's prefix; the salt is 0 if it is not hot."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def scan(batches):
        rarity, seen = shared.value, set()
        hot = rarity * HOT_SHARE > rarity.sum()
        for batch in batches:
            parts: list[tuple] = []
            size = 0
            for _, grams in _sets(batch, 1, n):
                key = _digest(grams)
                if not len(grams) or key in seen:
                    continue
                seen.add(key)
                length = len(grams) - -(-percent * len(grams) // 100) + 1
                order = np.lexsort((grams, rarity[_bucket(grams)]))[:length]
                salt = np.where(hot[_bucket(grams[order])], 1 + key[1] % SALTS, 0).astype(np.int32)
                parts.append((grams[order], key, len(grams), salt))
                size += length
                if size > 200_000:
                    yield _prefix_batch(parts)
                    parts, size = [], 0
            if parts:
                yield _prefix_batch(parts)

    return docs.mapInArrow(scan, "token long, hi long, lo long, size int, pos int, salt int")


def _prefix_batch(parts: list[tuple]) -> pa.RecordBatch:
    lengths = [len(p[0]) for p in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([p[0] for p in parts]).view(np.int64)),
         pa.array(np.repeat([p[1][0] for p in parts], lengths)),
         pa.array(np.repeat([p[1][1] for p in parts], lengths)),
         pa.array(np.repeat(np.array([p[2] for p in parts], np.int32), lengths)),
         pa.array(np.concatenate([np.arange(k, dtype=np.int32) for k in lengths])),
         pa.array(np.concatenate([p[3] for p in parts]))],
        names=["token", "hi", "lo", "size", "pos", "salt"])


def _may_link(percent: int, size_a, pos_a, size_b, pos_b) -> Column:
    """Length filter, and positional filter at a pair's first common n-gram."""
    fits = F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent
    rest = F.least(size_a - pos_a, size_b - pos_b)
    return fits & (rest * (100 + percent) >= (size_a + size_b) * percent)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b|, for sorted arrays of distinct values."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    common = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return common * (100 + percent) >= percent * (len(a) + len(b))


def _may_overlap(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: pairs whose parts could have enough n-grams in common.

    A part has at most the smaller of its two counts in common.
    """
    narrow = classes.select("cid", "n", "parts")
    both = (pairs.join(narrow.toDF("a", "size_a", "parts_a"), "a").join(narrow.toDF("b", "size_b", "parts_b"), "b")
            .select("a", "b", "size_a", "size_b", "parts_a", "parts_b"))

    def check(batches):
        for batch in batches:
            sizes = [batch.column(k).to_numpy().astype(np.int64) for k in (2, 3)]
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, PARTS)
                           for k in (4, 5))
            least = np.minimum(left, right)
            bound = least.sum(axis=1, dtype=np.int64)
            full = (least == 255).any(axis=1)  # a count that is not exact bounds nothing
            keep = full | (bound * (100 + percent) >= percent * (sizes[0] + sizes[1]))
            yield batch.select([0, 1]).filter(pa.array(keep))

    return both.mapInArrow(check, "a long, b long")


def _candidate_sets(docs: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """N-gram sets of the classes in ``wanted`` (cid, hi, lo, first_id).

    A fixed-size bit table of their first documents goes to the scan, so that few
    other texts are cut into n-grams and a class comes from one of its copies,
    however many it has; the join leaves exactly the wanted classes.
    """
    width = 1 << 12  # bytes a slice: those of one of Spark's bitmaps

    def bit(doc_id: str) -> Column:
        return F.shiftrightunsigned(F.xxhash64(doc_id), 64 - CANDIDATE_BITS).cast("int")

    table = np.zeros(((1 << CANDIDATE_BITS) // 8 // width, width), np.uint8)
    marked = wanted.select(bit("first_id").alias("bit"))
    at = F.col("bit") % (width * 8)
    for row in marked.groupBy((F.col("bit") / (width * 8)).cast("int").alias("slice")).agg(
            F.bitmap_construct_agg(at).alias("bits")).collect():
        table[row["slice"]] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(table.reshape(-1))

    def scan(batches):
        marks, seen = shared.value, set()
        for batch in batches:
            at = batch.column(0).to_numpy()
            batch = batch.filter(pa.array((marks[at >> 3] >> (at & 7) & 1).astype(bool)))
            out: list[tuple] = []
            size = 0
            for _, grams in _sets(batch, 1, n) if batch.num_rows else ():
                key = _digest(grams)
                if not len(grams) or key in seen:
                    continue
                seen.add(key)
                out.append((*key, grams.tobytes()))
                size += grams.nbytes
                if size > 4 << 20:
                    yield _set_batch(out)
                    out, size = [], 0
            if out:
                yield _set_batch(out)

    sets = docs.select(bit("doc_id").alias("at"), "text").mapInArrow(scan, "hi long, lo long, grams binary")
    # A repeated id can bring a class more than once.
    return (sets.join(wanted.select("cid", "hi", "lo"), ["hi", "lo"])
            .groupBy("hi", "lo").agg(F.first("cid").alias("cid"), F.first("grams").alias("grams"))
            .select("cid", "grams"))


def _set_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([r[2] for r in rows], pa.binary())], names=["hi", "lo", "grams"])


def _sets_of(docs: DataFrame, n: int, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """N-gram sets of the classes in ``ids`` (cid, repeated or not)."""
    return stage(_candidate_sets(docs, n, stage(classes.join(ids, "cid", "left_semi"), "jaccard-wanted")), "jaccard-sets")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("cid"))


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link."""
    both = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("grams").alias("left")), "a")
            .join(sets.select(F.col("cid").alias("b"), F.col("grams").alias("right")), "b")
            .select("a", "b", "left", "right"))

    def check(batches):
        for batch in batches:
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def _postings(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of docs (doc_id, text): a row per text, the classes of equal sets, and the lists of classes by prefix n-gram."""
    survey = stage(_survey(docs, n), "jaccard-survey")
    rows = survey.filter("slice is null").select("doc_id", "n", "hi", "lo", "parts")
    classes = stage(rows.filter("n > 0").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.min("parts").alias("parts"))
        .withColumn("cid", F.monotonically_increasing_id()), "jaccard-classes")

    prefixes = _prefixes(docs, n, percent, _frequencies(survey))
    # N-grams that one class alone holds go; hot ones stay unasked, and their rows are spread by the salt.
    same_token = Window.partitionBy("token", "salt")
    met = (prefixes.withColumn("x", F.min("lo").over(same_token)).withColumn("y", F.max("lo").over(same_token))
           .filter("x <> y or salt > 0").drop("x", "y").distinct())
    postings = stage(met.join(classes.select("hi", "lo", "cid"), ["hi", "lo"])
                     .select("token", "cid", "size", "pos"), "jaccard-postings")
    return rows, classes, postings


def _families(members: DataFrame, sets: DataFrame) -> DataFrame:
    """What most members (family, cid, size) of a family have in common.

    By family, ``union`` (the n-grams that a sample of it has more than once or
    mostly), ``core`` (which of them most have) and ``odd`` (how many of the sample
    differ from the core at an n-gram).  The sample is bounded; it decides the
    speed, not the result.
    """
    by_hash = Window.partitionBy("family").orderBy(F.xxhash64("cid"), "cid")
    sample = (members.withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= FAMILY_SAMPLE)
              .withColumn("grams_so_far", F.sum("size").over(by_hash))
              .filter((F.col("nth") == 1) | (F.col("grams_so_far") <= FAMILY_GRAMS)).select("family", "cid"))

    def common(table: pa.Table) -> pa.Table:
        own = [np.frombuffer(g, np.uint64) for g in table["grams"].to_pylist()]
        union, counts = np.unique(np.concatenate(own), return_counts=True)
        core = 2 * counts > len(own)
        kept = core | (counts > 1)
        union, counts, core = union[kept], counts[kept], core[kept]
        odd = np.where(core, len(own) - counts, counts).astype(np.uint8)
        return pa.table({"family": pa.array([table["family"][0].as_py()], pa.int64()),
                         **{name: pa.array([values.tobytes()], pa.binary())
                            for name, values in (("union", union), ("core", core), ("odd", odd))}})

    return stage(sample.join(sets, "cid").select("family", "grams").groupBy("family").applyInArrow(
        common, "family long, union binary, core binary, odd binary"), "jaccard-families")


def _differences(members: DataFrame, percent: int) -> DataFrame:
    """How each class of a family differs from the family's common set.

    A row per class (w null) with the number ``d`` of n-grams that only one of the
    two has, and a row for each of the first of them, the rarest in the sample first.
    """
    own = {"family": pa.int64(), "cid": pa.int64(), "size": pa.int32(), "root": pa.int64()}

    def scan(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                union, core = np.frombuffer(row["union"], np.uint64), np.frombuffer(row["core"], bool)
                odd = np.frombuffer(row["odd"], np.uint8)
                differs = np.setxor1d(np.frombuffer(row["grams"], np.uint64), union[core], assume_unique=True)
                often = np.zeros(len(differs), np.uint8)
                if len(union):
                    at = np.minimum(np.searchsorted(union, differs), len(union) - 1)
                    often = np.where(union[at] == differs, odd[at], 0)
                first = differs[np.lexsort((differs, often))][:row["size"] * (100 - percent) // percent + 1].view(np.int64)
                rows = len(first) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[c]] * rows, t) for c, t in own.items()]
                    + [pa.array([len(differs)] * rows, pa.int32()), pa.array([None, *first.tolist()], pa.int64()),
                       pa.array([None, *range(len(first))], pa.int32())],
                    names=[*own, "d", "w", "at"])

    return stage(members.mapInArrow(scan, "family long, cid long, size int, root long, d int, w long, at int"), "jaccard-differences")


def _may_meet(percent: int, size_a, d_a, at_a, size_b, d_b, at_b) -> Column:
    """Length filter, and the positional filter on what two classes of a family differ in.

    Sets that link differ in at most H n-grams, so of d_a + d_b differences from
    the common set at least (d_a + d_b - H) / 2 are shared.
    """
    both = size_a + size_b
    most = both - 2 * F.ceil(both * percent / (100 + percent))
    shared = F.greatest(F.lit(1), F.ceil((d_a + d_b - most) / 2))
    return ((F.least(size_a, size_b) * 100 >= F.greatest(size_a, size_b) * percent)
            & (at_a <= d_a - shared) & (at_b <= d_b - shared))


def _labelled(df: DataFrame, roots: DataFrame) -> DataFrame:
    """``df`` (cid) with the component of each class: ``root``, the class itself where it has no link."""
    return (df.join(roots, df["cid"] == roots["node"], "left").drop("node")
            .withColumn("root", F.coalesce("root", "cid")))


def _joined(links: DataFrame, roots: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links, and the components that they make (node, root); these stay as they are where no link is new."""
    if more.isEmpty():
        return links, roots
    links = links.unionByName(more)
    return links, component_stars(links)


def _family_links(members: DataFrame, further: DataFrame, sets: DataFrame, classes: DataFrame, percent: int,
                  links: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Join the components left in large lists, without comparing all their pairs: all links, and the components.

    Texts of a large list are mostly one another's near misses: they share almost
    all n-grams, and n-grams tell them apart only by being missing.  So each is
    described by what it has different from the set that most of them share.  Two
    that differ from it so little together that they link by that alone both link
    with the one that differs least: a star.  All others that link have a
    difference in common, so they meet on differences, rarest first.  There, too,
    a star of each list comes first, and only components left apart are compared
    pair by pair.  The pairs in ``further`` are verified with the stars.
    """
    labelled = _differences(members.join(_families(members, sets), "family").join(sets, "cid"), percent)

    def pair(x: str, y: str) -> list[Column]:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    spare = F.col("size") * (100 - percent) - F.col("d") * (100 + percent)     # below 0: too far from the common set
    members = labelled.filter("w is null").withColumn("spare", spare)
    least = members.groupBy("family").agg(F.max(F.struct("spare", "cid", "root")).alias("m"))
    certain = members.join(least, "family").filter("root <> m.root and spare + m.spare >= 0").select(*pair("cid", "m.cid"))
    listed = labelled.filter("w is not null")
    first = listed.groupBy("family", "w").agg(F.min(F.struct("at", "d", "size", "cid", "root")).alias("m"))
    star = listed.join(first, ["family", "w"]).filter(F.col("root") != F.col("m.root")).filter(_may_meet(
        percent, F.col("size"), F.col("d"), F.col("at"), F.col("m.size"), F.col("m.d"), F.col("m.at"))).select(*pair("cid", "m.cid"))
    compared = stage(certain.unionByName(star).distinct(), "jaccard-further")
    links, now = _joined(links, roots, stage(_checked(compared.unionByName(further), sets, percent), "jaccard-links"))

    if now is not roots:
        roots = now
        listed = stage(_labelled(listed.drop("root"), roots), "jaccard-labelled")
    mixed = listed.groupBy("family", "w").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    rest = stage(listed.join(mixed.drop("x", "y"), ["family", "w"], "left_semi"), "jaccard-apart")
    l, r = rest.alias("l"), rest.alias("r")
    same = (F.col("l.family") == F.col("r.family")) & (F.col("l.w") == F.col("r.w"))
    pairs = (l.join(r, same & (F.col("l.root") < F.col("r.root")) & _may_meet(
        percent, F.col("l.size"), F.col("l.d"), F.col("l.at"), F.col("r.size"), F.col("r.d"), F.col("r.at")))
        .select(*pair("l.cid", "r.cid")).distinct().join(compared, ["a", "b"], "left_anti"))
    pairs = stage(_may_overlap(pairs, classes, percent), "jaccard-pairs")
    return _joined(links, roots, stage(_checked(pairs, sets, percent), "jaccard-links"))


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All pairs under "n-gram Jaccard >= percent / 100", as links between classes and the classes' members.

    A class is one n-gram set (see ``jaccard_components``); its members are linked
    with one another and with the members of each linked class.  Returns the links
    (left_class, right_class: longs, left_class < right_class, each pair once,
    verified on the whole sets) and the members (doc_id, class_id; one row per
    input row, null for texts without words, which are linked with nothing).
    Class ids hold for the two results of one call.  The number of links can grow
    with the square of a group of near copies with different sets.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, classes, postings = _postings(docs, n, percent)
    # A list of m classes is looked through in m / LIST_CLASSES parts, each against the whole list.
    parts = F.ceil(F.count("*") / LIST_CLASSES).cast("int")
    lists = postings.groupBy("token").agg(F.count("*").alias("classes"), parts.alias("parts")).filter("classes > 1")
    listed = stage(postings.join(lists.drop("classes"), "token"), "jaccard-lists")
    l = listed.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int")).alias("l")
    r = listed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("r")
    pairs = (l.join(r, (F.col("l.token") == F.col("r.token")) & (F.col("l.part") == F.col("r.part"))
                    & (F.col("l.cid") < F.col("r.cid"))
                    & _may_link(percent, F.col("l.size"), F.col("l.pos"), F.col("r.size"), F.col("r.pos")))
             .select(F.col("l.cid").alias("a"), F.col("r.cid").alias("b")).distinct())
    pairs = stage(_may_overlap(pairs, classes, percent), "jaccard-pairs")
    links = stage(_checked(pairs, _sets_of(docs, n, classes, _ends(pairs)), percent), "jaccard-links")
    members = rows.join(classes.select("hi", "lo", F.col("cid").alias("class_id")), ["hi", "lo"], "left")
    return links.toDF("left_class", "right_class"), members.select("doc_id", "class_id")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = 5, percent: int = 80) -> DataFrame:
    """Component of every document under "n-gram Jaccard >= percent / 100".

    A text's set: the distinct runs of ``n`` words (runs of characters other than
    space and \\t-\\r, A-Z lower-cased); with fewer words, the whole word sequence.
    Returns one row per input row: doc_id, n_shingles (long), component_id (the
    smallest doc_id that links reach, itself included).

    Null or empty texts and texts without words have an empty set and are linked
    with nothing: their component is their own id.  Texts of any length are taken
    whole.  Repeated rows stay repeated.  A null id never is the smallest one
    unless the component has no other.  Other columns are not looked at.  An empty
    table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows, classes, postings = _postings(docs, n, percent)

    # Aggregates and joins here, no windows: a hot n-gram's rows are combined where they lie, its list can be split.
    first = postings.groupBy("token").agg(F.min(F.struct("pos", "size", "cid")).alias("p"))
    star = (postings.join(first, "token").filter("cid <> p.cid")
            .filter(_may_link(percent, F.col("size"), F.col("pos"), F.col("p.size"), F.col("p.pos")))
            .select(F.least("cid", "p.cid").alias("a"), F.greatest("cid", "p.cid").alias("b")).distinct())
    star = stage(_may_overlap(star, classes, percent), "jaccard-pairs")
    links = stage(_checked(star, _sets_of(docs, n, classes, _ends(star)), percent), "jaccard-links")

    roots = component_stars(links)
    labelled = stage(_labelled(postings, roots), "jaccard-labelled")
    # A list is large if its pairs are more than the n-grams of its classes, which is what families move.  The lists of
    # one group of texts hold nearly the same classes: those with the same smallest hash are one family.
    listed, pairs = F.count("*"), F.count("*") * (F.count("*") - 1) / 2
    lists = labelled.groupBy("token").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.min(F.xxhash64("cid")).alias("family"),
        ((listed > FAMILY_CLASSES) & (pairs > FAMILY_COST * F.sum("size"))).alias("large")).filter("x <> y").drop("x", "y")
    apart = stage(labelled.join(lists, "token"), "jaccard-apart")
    small = apart.filter("not large")
    l, r = small.alias("l"), small.alias("r")
    further = (l.join(r, (F.col("l.token") == F.col("r.token")) & (F.col("l.root") < F.col("r.root"))
                      & _may_link(percent, F.col("l.size"), F.col("l.pos"), F.col("r.size"), F.col("r.pos")))
               .select(F.least("l.cid", "r.cid").alias("a"), F.greatest("l.cid", "r.cid").alias("b")).distinct()
               .join(star, ["a", "b"], "left_anti"))
    further = stage(_may_overlap(further, classes, percent), "jaccard-pairs")
    large = apart.filter("large").select("family", "cid", "size", "root")
    if large.isEmpty():
        sets = _sets_of(docs, n, classes, _ends(further))
        links, roots = _joined(links, roots, stage(_checked(further, sets, percent), "jaccard-links"))
    else:
        members = stage(large.distinct(), "jaccard-members")
        sets = _sets_of(docs, n, classes, members.select("cid").unionByName(_ends(further)))
        links, roots = _family_links(members, further, sets, classes, percent, links, roots)

    in_groups = classes.drop("n", "parts").join(roots, classes["cid"] == roots["node"], "left").select(
        "hi", "lo", "first_id", F.coalesce("root", "cid").alias("root"))
    lowest = in_groups.groupBy("root").agg(F.min("first_id").alias("lowest"))
    of_class = in_groups.join(lowest, "root").select("hi", "lo", "lowest")
    own = rows.drop("parts").join(of_class, ["hi", "lo"], "left")
    component = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    return own.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))


def keep_one_per_group(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, unchanged: the one with the smallest doc_id.

    A document is judged by its id and a 64-bit digest of its text, so a text with a
    null or a shared id is judged as itself; null ids come last, equal ids go by the
    digest.  Rows with one id and one text are one document and stay or go
    together.  Documents linked with nothing stay, those without words included.
    Other columns may have any names.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), text_digest(text).alias("digest"))
    groups = jaccard_components(docs.select(key.alias("key"), text.alias("text")), "key", n=n, percent=percent)
    gone = groups.filter("not (doc_id <=> component_id)").select(
        F.col("doc_id.doc_id").alias("gone_id"), F.col("doc_id.digest").alias("gone_text"))
    return without(docs, gone, "jaccard-gone")
