"""Near-duplicate texts by min-max hashing, banding and exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.llm.exchange import expand, squeeze
from skein.llm.links import components
from skein.llm.text import mix, shingle_hashes, utf8, word_hashes
from skein.session import materialize


#: Least and most bits of a set's bitmap; members of a bucket that one task compares.
BITS, MOST_BITS, BLOCK = 2048, 1 << 17, 4096


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, at = word_hashes(*utf8(column))
    h, at = shingle_hashes(words, at, k)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


class MinMax:
    """Signatures that keep both the least and the largest value under each permutation.

    A signature of bands*rows values takes half as many hash evaluations as
    MinHash; either extreme agrees with probability equal to the Jaccard
    similarity, and the two are slightly negatively correlated.
    """

    def __init__(self, bands: int = 40, rows: int = 5, seed: int = 1):
        if bands * rows % 2:
            raise ValueError("bands * rows must be even: values come in pairs")
        rng, n = np.random.default_rng(seed), bands * rows // 2
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, n, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, n, dtype=np.uint64)[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.a), np.uint64)
        for i in range(0, len(shingles), 4096):
            x = shingles[None, i : i + 4096] * self.a + self.b
            np.minimum(low, x.min(1), out=low)
            np.maximum(high, x.max(1), out=high)
        return np.stack([low, high], 1).ravel()

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """One bucket key per band, as signed 64-bit integers."""
        s = self.signature(shingles).reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(self.rows):
            key = mix(key ^ s[:, r])
        return key.view(np.int64)


def near_documents(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = 40, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept): groups of near-duplicate texts.

    A text's set holds its distinct k-word shingles (A-Z folded); a text of
    fewer words is one shingle; a null text or one without words has the empty
    set and links with nothing. Texts link when 100*|intersection| >=
    percent*|union|, always confirmed on the full sets (of 64-bit shingle
    hashes). component_id is the smallest doc_id that links reach, kept marks
    it. Equal sets are one class from the start, and all work is done by class:
    a doc_id that stands on several texts belongs to several classes, which it
    ties together. A null doc_id links with nothing (component_id null, kept
    false).

    Candidates are the classes that share a band (at similarity 0.8, 40 bands
    of 5 miss one pair in ten million). First every member of a bucket is held
    against its least member. Then, as long as a bucket holds several
    components, it proposes the closest pairs between them that a bitmap of the
    sets cannot rule out: one forest over the components, then 16, 256 and so
    on, and full sets decide; proposals that failed are not made again. It ends when no pair is left that could link, so no link between candidates
    is lost.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = MinMax(bands, rows)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = shingle_sets(part.column(1), k)
                keys = [maker.keys(s) if len(s) else None for s in sets]
                cols = [part.column(0), pa.array([len(s) for s in sets], pa.int64()), *_digests(sets), pa.array(keys, pa.list_(pa.int64())), pa.array([bitmap(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, ["id", "n", "h1", "h2", "keys", "bits"])

    signs = materialize(source.mapInArrow(signed, "id long, n long, h1 long, h2 long, keys array<long>, bits binary"), "signatures")
    usable = signs.where("n > 0 AND id IS NOT NULL")
    classes = usable.groupBy("h1", "h2", "n").agg(F.min("id").alias("first")).withColumn("rep", F.monotonically_increasing_id())
    classes = materialize(classes, "classes")
    tied = usable.select("id", "h1", "h2", "n").distinct().join(classes, ["h1", "h2", "n"]).select("id", "rep")  # an id with several texts ties their classes
    tied = tied.join(tied.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("_z")).where("a < _z"), "id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    name = ["id", "h1", "h2", "n"]
    leaders = usable.join(classes.withColumnRenamed("first", "id"), name).dropDuplicates(name)  # dealt by the join's own keys
    bucket = Window.partitionBy("key")  # entries are dealt by their key once, which finds shared keys and their least members together
    entries = leaders.select("rep", "n", F.explode("keys").alias("key"))
    held = entries.withColumns({"least": F.min(F.struct("rep", "n")).over(bucket), "high": F.max("rep").over(bucket)}).where("least.rep < high")
    buckets = materialize(held.select("key", "rep", "n", F.col("least.rep").alias("a"), F.col("least.n").alias("an")), "buckets")
    wanted = materialize(classes.join(buckets.select("rep").distinct(), "rep", "left_semi"), "wanted")
    several = usable.groupBy("id").count().where("count > 1").select(F.col("id").alias("first"))
    once, more = wanted.join(several, "first", "left_anti"), materialize(wanted.join(several, "first", "left_semi"), "repeated")
    packed = _packed(source)  # what is shuffled from here on are packed texts, a third of the size of packed shingles
    texts = packed.join(once, F.col("id") == F.col("first")).select("rep", "packed")
    if not more.isEmpty():  # an id that stands on several rows: its texts are told apart by their class
        again = _named(packed.join(more.select("first").distinct(), F.col("id") == F.col("first"), "left_semi"), k)
        texts = texts.unionByName(again.join(more, ["first", "h1", "h2", "n"]).select("rep", "packed").dropDuplicates(["rep"]))
    texts = materialize(texts.withColumnRenamed("rep", "id"), "texts")
    maps = usable.select(*name, "bits").join(wanted.withColumnRenamed("first", "id"), name).dropDuplicates(name)
    maps = materialize(maps.select(F.col("rep").alias("who"), "bits"), "bitmaps")

    pairs = buckets.where(F.col("rep") > F.col("a")).where(100 * F.least("n", "an") >= percent * F.greatest("n", "an")).select("a", F.col("rep").alias("b"))
    pairs = materialize(pairs.distinct(), "pairs")
    found = materialize(_confirmed(pairs, texts, k, percent), "confirmed")
    failed, turn = materialize(pairs.join(found, ["a", "b"], "left_anti"), "failed"), 0
    labels = components(found.unionByName(tied))
    while True:
        known = labels.select(F.col("node"), F.col("component"))
        now = buckets.join(known, F.col("rep") == F.col("node"), "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("label"))
        mixed = now.withColumns({"low": F.min("label").over(bucket), "high": F.max("label").over(bucket)}).where("low < high").drop("low", "high")
        now = materialize(mixed.join(maps, F.col("rep") == F.col("who")).drop("who"), "mixed")
        turn += 1
        pairs = materialize(_proposed(now, failed, percent, 16 ** (turn - 1)), "pairs")
        if pairs.isEmpty():
            break
        found = materialize(_confirmed(pairs, texts, k, percent), "confirmed")
        failed = failed.unionByName(materialize(pairs.join(found, ["a", "b"], "left_anti"), "failed"))
        if not found.isEmpty():
            labels = _merged(labels, found)
    ids = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")
    least = ids.groupBy("label").agg(F.min("first").alias("component"))
    ids = ids.join(least, "label").select("h1", "h2", "n", "component")
    out = signs.select("id", "n", "h1", "h2").join(ids, ["h1", "h2", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels after more links: only the components that the links touch are worked on."""
    ends = links
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias("k"), F.col("component").alias("c"))
        ends = ends.join(known, F.col(end) == F.col("k"), "left").withColumn(end, F.coalesce("c", end)).drop("k", "c")
    more = components(ends).select(F.col("node").alias("old"), F.col("component").alias("new"))
    fresh = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(labels, "node", "left_anti").select("node", F.col("node").alias("component"))
    both = labels.unionByName(fresh).join(more, F.col("component") == F.col("old"), "left")
    return materialize(both.select("node", F.coalesce("new", "component").alias("component")), "labels")


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each bit: two sets' bitmaps differ in no more bits than the sets in shingles.

    A bitmap has a bit for each shingle or more, up to MOST_BITS, so that long
    texts do not fill it; a wide one is folded to the width of a narrow one.
    """
    bits = min(MOST_BITS, max(BITS, 1 << max(0, len(shingles) - 1).bit_length()))
    at = (mix(shingles) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool)).tobytes()


def folded(bits: list[bytes]) -> dict[int, np.ndarray]:
    """The bitmaps of a bucket at each width that occurs, in 64-bit words; narrower ones are zero there and not to be used."""
    out = {}
    for width in sorted({len(b) for b in bits}):
        rows = np.zeros((len(bits), width // 8), np.uint64)
        for i, b in enumerate(bits):
            x = np.frombuffer(b, "<u8")
            while len(x) > width // 8:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            if len(x) == width // 8:
                rows[i] = x
        out[width] = rows
    return out


def _proposed(members: DataFrame, failed: DataFrame, percent: int, forests: int) -> DataFrame:
    """Pairs (a, b) for the full sets to decide: so many forests of the closest pairs between a bucket's components, one after the other.

    members are rows (key, rep, n, label, bits) of buckets with several
    components. Pairs that failed before, and those whose sizes or bitmaps
    prove them too different, are left out. Buckets over BLOCK members are cut
    into pairs of blocks.
    """
    size = members.groupBy("key").count().where(F.col("count") > BLOCK).select(F.col("key").alias("k"), F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    cut = members.join(size, F.col("key") == F.col("k"), "left").drop("k").withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("rep"), F.col("blocks"))).cast("int"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    banned = failed.groupBy(F.col("b").alias("fb")).agg(F.collect_set("a").alias("no"))  # the larger id knows: at most one per bucket and round
    cut = cut.join(banned, F.col("rep") == F.col("fb"), "left").select("key", "low", "high", "block", "rep", "n", "label", "bits", F.coalesce("no", F.array().cast("array<long>")).alias("no"))
    dealt = cut.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "label", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            key = np.stack([t.column(c).to_numpy() for c in ("key", "low", "high")], 1)
            differs = np.flatnonzero((key != key[-1]).any(1))
            end = int(differs[-1]) + 1 if len(differs) else 0
            held = t.slice(end)  # the last bucket may go on
            if end:
                yield _closest(t.slice(0, end), percent, forests)
        if held is not None and held.num_rows:
            yield _closest(held, percent, forests)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _closest(t: pa.Table, percent: int, forests: int) -> pa.RecordBatch:
    """Pairs (a, b) of whole buckets, or blocks of them, that only the full sets can decide; see _proposed."""
    key = np.stack([t.column(c).to_numpy() for c in ("key", "low", "high")], 1)
    block, rep, n = (t.column(c).to_numpy() for c in ("block", "rep", "n"))
    label = t.column("label").to_numpy()
    bits, refused = t.column("bits").to_pylist(), t.column("no").to_pylist()
    begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(1)]))
    out_a, out_b = [], []
    for lo, hi in zip(begin, np.append(begin[1:], len(rep)), strict=True):
        rows = np.arange(lo, hi)
        if len(rows) < 2:
            continue
        size, mine, who, side = n[rows], label[rows], rep[rows], block[rows]
        mine_bits = [bits[i] for i in rows]
        width, maps = np.array([len(b) for b in mine_bits]), folded(mine_bits)
        names, groups = np.unique(mine, return_inverse=True)
        if len(names) < 2:
            continue
        lone = np.flatnonzero(groups != np.bincount(groups).argmax())  # every mixed pair has an end outside the largest component
        at = {int(w): i for i, w in enumerate(who)}
        banned = {(at[int(b)], at[a]) for b, no in zip(who, refused[lo:hi], strict=True) for a in no if a in at}
        banned |= {(b, a) for a, b in banned}
        row_of = {int(x): i for i, x in enumerate(lone)}
        stop = np.array([(row_of[a], b) for a, b in banned if a in row_of], np.int64).reshape(-1, 2)
        near_i, near_j, near_d = [], [], []  # pairs that only the full sets can decide
        for s in range(0, len(lone), 256):
            x = lone[s : s + 256]
            both = size[x][:, None] + size[None]
            room = both - 2 * -(-percent * both // (100 + percent))
            ok = (groups[x][:, None] != groups[None]) & (100 * np.minimum(size[x][:, None], size[None]) >= percent * np.maximum(size[x][:, None], size[None]))
            if key[lo, 1] != key[lo, 2]:
                ok &= side[x][:, None] != side[None]
            here = stop[(stop[:, 0] >= s) & (stop[:, 0] < s + 256)]
            ok[here[:, 0] - s, here[:, 1]] = False
            i, j = np.nonzero(ok)
            apart = np.zeros(len(i), np.int32)
            narrow = np.minimum(width[x[i]], width[j])
            for size_, rows_ in maps.items():
                pick = np.flatnonzero(narrow == size_)
                p, q = x[i[pick]], j[pick]
                for w in range(rows_.shape[1]):
                    apart[pick] += np.bitwise_count(rows_[p, w] ^ rows_[q, w])
            fits = apart <= room[i, j]
            near_i.append(x[i[fits]])
            near_j.append(j[fits])
            near_d.append(apart[fits])
        i, j, d = (np.concatenate(v) for v in (near_i, near_j, near_d))
        keep, left = [], np.argsort(d, kind="stable").tolist()
        for _ in range(forests):  # each a forest of the closest pairs left
            if not left:
                break
            roots, rest = list(range(len(names))), []
            for e in left:
                p, q = int(groups[i[e]]), int(groups[j[e]])
                while roots[p] != p:
                    p = roots[p]
                while roots[q] != q:
                    q = roots[q]
                if p != q:
                    roots[max(p, q)] = min(p, q)
                    keep.append(e)
                else:
                    rest.append(e)
            left = rest
        i, j = i[keep], j[keep]
        out_a.append(who[i])
        out_b.append(who[j])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_a, out_b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _digests(sets: list[np.ndarray]) -> tuple[pa.Array, pa.Array]:
    """Two 64-bit digests of each set; with its size they name its class."""
    one = np.array([np.bitwise_xor.reduce(mix(s)) if len(s) else 0 for s in sets], np.uint64)
    two = np.array([np.add.reduce(mix(s + np.uint64(9))) if len(s) else 0 for s in sets], np.uint64)
    return pa.array(one.view(np.int64)), pa.array(two.view(np.int64))


def _packed(source: DataFrame) -> DataFrame:
    """source (id, text) as rows (id, packed): texts compressed one by one, before any shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                packed = [squeeze(x.encode()) if x else squeeze(b"") for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary())], ["id", "packed"])

    return source.mapInArrow(run, "id long, packed binary")


def _sets(packed: list[bytes], k: int) -> list[np.ndarray]:
    """The shingle sets of packed texts."""
    return shingle_sets(pa.array([expand(x) for x in packed], pa.large_binary()), k)


def _named(packed: DataFrame, k: int) -> DataFrame:
    """packed (id, packed) as rows (first, n, h1, h2, packed), with what names the class of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = _sets(part.column(1).to_pylist(), k)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), *_digests(sets), part.column(1)], ["first", "n", "h1", "h2", "packed"])

    return packed.mapInArrow(run, "first long, n long, h1 long, h2 long, packed binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets, made again from the packed texts, are similar enough."""
    left, right = texts.select(F.col("id").alias("a"), F.col("packed").alias("ta")), texts.select(F.col("id").alias("b"), F.col("packed").alias("tb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                once = dict(zip(a, part.column("ta").to_pylist(), strict=True)) | dict(zip(b, part.column("tb").to_pylist(), strict=True))
                sets = dict(zip(once, _sets(list(once.values()), k), strict=True))
                keep = []
                for x, y in zip(a, b, strict=True):
                    both = np.sort(np.concatenate([sets[x], sets[y]]), kind="stable")  # two sorted runs
                    common = int(np.count_nonzero(both[1:] == both[:-1]))
                    keep.append(100 * common >= percent * (len(both) - common))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(mask), part.column("b").filter(mask)], ["a", "b"])

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long").distinct()
