"""Near-duplicate documents by HyperMinHash sketches, banded registers and exact checks.

1. A document's set: hashes of its word shingles. Each of ``REGISTERS`` buckets sees every shingle under its own rehash (short
   documents leave no bucket empty) and keeps the least value, compressed to the count of leading zeros and
   ``MANTISSA`` bits after them: 16 bits a register.
2. Documents with the same words in the same order are one class, numbered when the classes are written; from here on classes are compared, by the
   text of one row each, and doc_ids come back in the result only. So rows that share a doc_id don't stand for one another.
3. Four registers are a band; documents that share one meet in a bucket. In every bucket the document that meets the most others
   overall is compared with each of the rest: a number of pairs linear in the bucket. A pair is passed on if its Jaccard estimate,
   corrected for chance collisions of compressed registers, is within ``SLACK`` of the threshold, and is then confirmed on the full sets.
4. Buckets whose members are not in one component yet are searched to the end: members outside the bucket's largest component are
   compared with all others, by estimate and then by full sets, in blocks of bounded size dealt out pair by pair. Documents that are in one
   component by now are passed over, and a pair that meets in several bands is compared in the first. A block hands on
   a link for each two components it joins, never its pairs, so results are linear in the size of a bucket and no link that joins components is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyweave.llm.components import components
from keyweave.llm.shared import lower_words, runs_by_key, slices, stored, table_batch, unwrapped, wrapped

BANDS = 20
LANES = 4
REGISTERS = BANDS * LANES
MANTISSA = 10
SLACK = 0.2
BLOCK = 500
BLOCK_SHINGLES = 1 << 21
SKETCHED_BYTES = 32 << 20
_RNG = np.random.default_rng(20240229)
_XOR = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def registers(hashes: np.ndarray) -> np.ndarray:
    """Compressed least value of each bucket: 1024 for each bit of the value's length, plus the ``MANTISSA`` bits after
    the first one bit."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[i:i + 4096, None] ^ _XOR) * _ODD).min(axis=0))
    exact = ((least >> np.uint64(12)) | np.uint64(1)).astype(np.float64)  # 52 bits, exact as a float
    return ((exact.view(np.uint64) >> np.uint64(52 - MANTISSA)) & np.uint64(0xFFFF)).astype(np.uint16)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Different shingle hashes of a document from its words' hashes; fewer words than ``width`` are one shingle."""
    if not len(words):
        return words
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), len(words))], dtype=np.uint64)
    total = words[:len(words) - width + 1].copy()
    for i in range(1, width):
        total = _mixed(total) + words[i:len(words) - width + 1 + i]
    return np.unique(_mixed(total))


_SKETCH = pa.schema([("doc_id", pa.int64()), ("print", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sketch(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SKETCHED_BYTES):
                words, codes, cuts = lower_words(part.column("text"))
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), dtype=np.uint64, count=len(words))[codes]
                rows = []
                for i, (doc, mark) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("print").to_pylist())):
                    own = hashes[cuts[i]:cuts[i + 1]]
                    found = shingle_hashes(own, width)
                    bands = registers(found).view(np.int64).tolist() if len(found) else None
                    rows.append((doc, mark, len(found), xxhash.xxh3_128_digest(own.tobytes()) if len(found) else None, bands))
                yield table_batch(rows, _SKETCH)

    return run


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, print (of the text, see ``_print``), n_shingles, class (of equal word sequences) and bands of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _print(F.col("text")).alias("print"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_sketch(width), "doc_id long, print long, n_shingles long, class binary, bands array<long>")


def _print(text: Column) -> Column:
    """Hash of a text, null as empty: with the doc_id it names a row, or several that are the same."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Chance that two unequal least values fall on the same register: in the scale of one leading-zero count they agree in the mantissa.
COLLISION = 1 / (1 << (MANTISSA + 1))


def estimate(equal: Column) -> Column:
    """Jaccard estimate from the number of equal registers."""
    return (equal / REGISTERS - COLLISION) / (1 - COLLISION)


def _equal_registers(a: Column, b: Column) -> Column:
    lane = lambda z, i: (z.bitwiseAND(F.lit(0xFFFF << (16 * i) if i < 3 else -(1 << 48))) == 0).cast("int")
    each = F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y))
    return F.aggregate(each, F.lit(0), lambda n, z: n + sum(lane(z, i) for i in range(LANES)))


def _confirm(width: int, threshold: int):
    """Of rows (a, b, text_a, text_b), the pairs with 100 * intersection >= threshold * union of their full shingle sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def shingles(text: str) -> frozenset:
        words = text.encode().lower().split()
        if len(words) < width:
            return frozenset([tuple(words)] if words else [])
        return frozenset(zip(*(words[i:] for i in range(width))))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_id, last = None, frozenset()
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if a != last_id:
                    last_id, last = a, shingles(x)
                other = shingles(y)
                common = len(last & other)
                if common and 100 * common >= threshold * (len(last) + len(other) - common):
                    rows.append((a, b))
            if rows:
                yield table_batch(rows, schema)

    return run


class _Search:
    """State of one run: texts and sketches of the documents that share a bucket."""

    def __init__(self, docs: DataFrame, width: int, threshold: int):
        self.width, self.threshold = width, threshold
        self.sketched = stored(sketches(docs, width), "sketches")
        first = F.min(F.struct("doc_id", "print"))
        self.classes = stored(self.sketched.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
                              .groupBy("class").agg(first.alias("first"), F.first("bands").alias("bands"), F.first("n_shingles").alias("weight"))
                              .withColumn("rep", F.monotonically_increasing_id()), "classes")
        entries = self.classes.select("rep", "weight", F.posexplode("bands").alias("band", "key"))
        sizes = stored(entries.groupBy("band", "key").agg(F.count("*").alias("size")).where(F.col("size") > 1), "buckets")
        self.entries = stored(entries.join(sizes, ["band", "key"]), "entries")
        degree = stored(self.entries.groupBy("rep").agg(F.sum("size").alias("degree")), "degrees")
        self.signs = stored(degree.select("rep").join(self.classes.select("rep", "bands", "first"), "rep"), "signs")
        self.degree = degree
        texts = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), _print(F.col("text")).alias("print")).alias("first"), "text")
        self.texts = stored(texts.join(self.signs.select("first", "rep"), "first").select("rep", "text").dropDuplicates(["rep"]), "texts")

    def stars(self) -> DataFrame:
        """Each bucket's members with its busiest member."""
        busy = self.entries.join(self.degree, "rep")
        heads = stored(busy.groupBy("band", "key").agg(F.max(F.struct("degree", (-F.col("rep")).alias("minus"))).alias("top"))
                       .select("band", "key", (-F.col("top.minus")).alias("b")), "heads")
        pairs = self.entries.join(heads, ["band", "key"]).where(F.col("rep") != F.col("b")).select(F.col("rep").alias("a"), "b").distinct()
        a, b = self.signs.select(F.col("rep").alias("a"), F.col("bands").alias("x")), self.signs.select(F.col("rep").alias("b"), F.col("bands").alias("y"))
        near = estimate(_equal_registers(F.col("x"), F.col("y"))) >= self.threshold / 100 - SLACK
        return stored(pairs.join(b, "b").join(a, "a").where(near).select("a", "b"), "stars")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        a = self.texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
        b = self.texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
        rows = pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b")
        return stored(rows.mapInArrow(_confirm(self.width, self.threshold), "a long, b long"), "confirmed")

    def labelled(self, found: DataFrame) -> DataFrame:
        """Entries of buckets with several components: rep, band, key, label (component), main (is it the bucket's largest), and in how many blocks
        the main members and those outside are cut, ``n_main`` and ``n_out``."""
        labels = self.entries.join(found.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("label", F.coalesce("root", "rep"))
        labels = stored(labels.select("rep", "band", "key", "weight", "label"), "labels")
        each = labels.groupBy("band", "key", "label").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
        blocks = lambda n, w: F.greatest(F.lit(1), F.ceil(n / BLOCK), F.ceil(w / BLOCK_SHINGLES)).cast("int")
        top = F.col("top")
        open_ = stored(each.groupBy("band", "key").agg(F.count("*").alias("labels"), F.max(F.struct("n", "label", "w")).alias("top"),
                                                       F.sum("n").alias("n"), F.sum("w").alias("w")).where(F.col("labels") > 1)
                       .select("band", "key", top["label"].alias("most"), blocks(top["n"], top["w"]).alias("n_main"),
                               blocks(F.col("n") - top["n"], F.col("w") - top["w"]).alias("n_out")), "open")
        return stored(labels.join(open_, ["band", "key"]).select(
            "rep", "band", "key", "weight", "label", (F.col("label") == F.col("most")).alias("main"), "n_main", "n_out"), "open-entries")

    def sets(self, reps: DataFrame) -> DataFrame:
        """rep, bands and the shingle hashes, sorted, of some documents."""
        rows = self.texts.join(reps, "rep").join(self.signs, "rep").select("rep", "bands", F.coalesce("text", F.lit("")).alias("text"))
        return stored(rows.mapInArrow(_hashed_sets(self.width), "rep long, bands array<long>, hashes binary"), "sets")

    def within(self, open_entries: DataFrame) -> DataFrame:
        """Links a, b that join components within open buckets."""
        own = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        n_out, n_main = F.col("n_out"), F.col("n_main")
        block = F.when(F.col("main"), n_out + own(n_main)).otherwise(own(n_out))
        # members outside meet one another in places (i, j) with i <= j < n_out, and the main ones in places (i, j) with j >= n_out
        outside = F.transform(upto(n_out + n_main), lambda j: F.when(j < n_out, F.struct(F.least(F.col("block"), j).alias("i"), F.greatest(F.col("block"), j).alias("j")))
                              .otherwise(F.struct(F.col("block").alias("i"), j.alias("j"))))
        inside = F.transform(upto(n_out), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
        small = (n_out == 1) & (n_main == 1)
        place = F.when(small, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).when(F.col("main"), inside).otherwise(outside)
        keys = ["band", "key", "i", "j"]
        tasks = (open_entries.withColumn("block", F.when(small, 0).otherwise(block)).withColumn("at", F.explode(place))
                 .select("rep", "band", "key", "weight", "label", "main", "block", F.col("at.i").alias("i"), F.col("at.j").alias("j")))
        dealt = lambda rows: rows.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
        # by estimate first, so that full sets are sent only for members that have somebody to be compared with
        places = stored(tasks, "places")
        likely = stored(dealt(places.join(self.signs, "rep")).mapInArrow(_likely(keys, self.threshold, places.columns), ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in places.schema)), "likely")
        sets = self.sets(likely.select("rep").distinct())
        return stored(dealt(likely.join(sets, "rep")).mapInArrow(_joins(keys, self.threshold), "a long, b long"), "joins")

    def links(self) -> DataFrame:
        links = self.confirmed(self.stars())
        found = components(links)
        more = self.within(self.labelled(found))
        return found if more.isEmpty() else components(links.unionByName(more))

    def groups(self) -> DataFrame:
        """Of every class: class, first (its least doc_id, and the text's print) and lead (the least first of its component)."""
        found = self.links()
        linked = stored(found.unionByName(found.select(F.col("root").alias("node"), "root").distinct()), "linked")
        leads = (linked.join(self.classes.select(F.col("rep").alias("node"), "first"), "node").groupBy("root").agg(F.min("first").alias("lead")))
        led = linked.join(leads, "root").select(F.col("node").alias("rep"), "lead")
        return self.classes.select("class", "rep", "first").join(led, "rep", "left").select("class", "first", F.coalesce("lead", "first").alias("lead"))


_SETS = pa.schema([("rep", pa.int64()), ("bands", pa.list_(pa.int64())), ("hashes", pa.binary())])


def _hashed_sets(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SKETCHED_BYTES):
                words, codes, cuts = lower_words(part.column("text"))
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), dtype=np.uint64, count=len(words))[codes]
                sets = [shingle_hashes(hashes[cuts[i]:cuts[i + 1]], width).tobytes() for i in range(len(part))]
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("bands"), pa.array(sets, pa.binary())], schema=_SETS)

    return run


class _Block:
    """Members of a bucket's block pair: which of them are in one component is kept up to date while links are found."""

    def __init__(self, table: pa.Table, threshold: int):
        main = table.column("main").to_numpy(zero_copy_only=False)
        order = np.argsort(main, kind="stable")  # members outside the largest component first
        self.outside = int((~main).sum())
        self.rep, self.block = table.column("rep").to_numpy()[order], table.column("block").to_numpy()[order]
        self.root = np.unique(table.column("label").to_numpy()[order], return_inverse=True)[1]
        self.bands = np.array(table.column("bands").combine_chunks().flatten()).reshape(len(order), BANDS)[order]
        self.signs = self.bands.view(np.uint16).reshape(len(order), REGISTERS)
        self.order, self.sizes = order, table.column("weight").to_numpy()[order]
        if "hashes" in table.column_names:
            raw = table.column("hashes").to_pylist()
            self.sets = [np.frombuffer(raw[k], dtype=np.uint64) for k in order]
        self.band, self.apart = table.column("band")[0].as_py(), table.column("i")[0].as_py() != table.column("j")[0].as_py()
        self.threshold = threshold
        self.least = ((threshold / 100 - SLACK) * (1 - COLLISION) + COLLISION) * REGISTERS

    def near(self, i: int) -> np.ndarray:
        """Later members that may be linked with member i and aren't in its component, the likeliest first."""
        may = self.root[i + 1:] != self.root[i]
        if self.apart:
            may &= self.block[i + 1:] != self.block[i]
        small, large = np.minimum(self.sizes[i + 1:], self.sizes[i]), np.maximum(self.sizes[i + 1:], self.sizes[i])
        found = i + 1 + np.flatnonzero(may & (100 * small >= self.threshold * large))
        equal = (self.signs[found] == self.signs[i]).sum(axis=1)
        found, equal = found[equal >= self.least], equal[equal >= self.least]
        if self.band and len(found):
            first = ~(self.bands[found, :self.band] == self.bands[i, :self.band]).any(axis=1)
            found, equal = found[first], equal[first]
        return found[np.argsort(-equal, kind="stable")]

    def linked(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` whose full sets are similar enough to that of member i."""
        own = self.sets[i]
        every = np.concatenate([self.sets[k] for k in others])
        at = np.minimum(np.searchsorted(own, every), len(own) - 1)
        starts = np.concatenate([[0], np.cumsum(self.sizes[others])[:-1]])
        common = np.add.reduceat((own[at] == every).astype(np.int64), starts)
        return others[100 * common >= self.threshold * (len(own) + self.sizes[others] - common)]

    def likely(self) -> np.ndarray:
        """Rows of the table that have somebody near, in their order."""
        chosen = np.zeros(len(self.order), dtype=bool)
        for i in range(self.outside):
            near = self.near(i)
            chosen[near] = True
            chosen[i] |= len(near) > 0
        return np.sort(self.order[chosen])

    def joins(self) -> Iterator[tuple[int, int]]:
        for i in range(self.outside):
            rest, step = self.near(i), 8
            while len(rest):
                for k in self.linked(i, rest[:step]).tolist():
                    if self.root[k] != self.root[i]:
                        yield int(self.rep[i]), int(self.rep[k])
                        self.root[self.root == self.root[k]] = self.root[i]
                rest = rest[step:]
                rest = rest[self.root[rest] != self.root[i]]
                step = min(2 * step, 256)


def _likely(keys: list[str], threshold: int, columns: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs_by_key(batches, keys):
            chosen = _Block(table, threshold).likely()
            if len(chosen):
                yield from table.select(columns).take(pa.array(chosen)).combine_chunks().to_batches()

    return run


def _joins(keys: list[str], threshold: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for table in runs_by_key(batches, keys):
            out += _Block(table, threshold).joins()
            if len(out) > 20_000:
                yield table_batch(out, schema)
                out = []
        if out:
            yield table_batch(out, schema)

    return run


def near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Words are runs without ASCII white space, A-Z lower-cased; the set holds the different ``width``-word shingles, of a shorter text all its words as one.
    Documents are linked if 100 * intersection >= ``threshold`` * union. component_id is the least doc_id reachable by links, itself
    included, kept says whether it is the row's own. A null or empty text, or one of white space, has no shingles and is linked
    with nothing. Rows that share a doc_id are compared each by its own text, repeated rows give repeated results; a row without a doc_id takes part in no
    link but that with rows of the same words, and is kept only where no such row has an id. An empty table gives an
    empty result. Other columns are not read.
    """
    search = _Search(docs, width, threshold)
    groups = search.groups().select("class", F.col("lead.doc_id").alias("component"))
    out = search.sketched.join(groups, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The rows of ``docs``, with its columns, of which one stays for each group of ``near_duplicates``: that with the least doc_id, and of
    different texts that share it the one with the least hash, once. Rows without words stay, those that are the same in doc_id and text once; rows
    without a doc_id stay, repeated as they are."""
    search = _Search(docs, width, threshold)
    kept = search.groups().where(F.col("first") == F.col("lead")).select("first.doc_id", "first.print")
    bare = search.sketched.where((F.col("n_shingles") == 0) & F.col("doc_id").isNotNull()).select("doc_id", "print")
    kept = kept.unionByName(bare).distinct().select(F.col("doc_id").alias("kw_kept"), F.col("print").alias("kw_text"))
    rows = wrapped(docs, F.col("doc_id").cast("long").alias("kw_id"), _print(F.col("text")).alias("kw_print"))
    named = rows.where(F.col("kw_id").isNotNull()).join(kept, (F.col("kw_id") == F.col("kw_kept")) & (F.col("kw_print") == F.col("kw_text")), "left_semi")
    return unwrapped(named.dropDuplicates(["kw_id", "kw_print"]).unionByName(rows.where(F.col("kw_id").isNull())), docs)
