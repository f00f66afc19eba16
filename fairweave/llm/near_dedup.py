"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set of word shingles is sketched in rounds: in round i every shingle is
hashed to a bin and a value, and a bin keeps the least value of the first round that
reached it.  After as many rounds as bins, each further round is bound to one bin, so
that every coordinate fills, however small the set; large sets fill in one or two rounds.
Coordinates agree with a probability equal to the similarity, and concentrate as if the
bins had been filled independently.

Documents of equal sets form a class.  Classes that share a band of coordinates are
candidates; the connected groups of candidates are split into parts of bounded size, and
within a part, together with a few hubs of its group, all overlaps are counted on the full
sets.  Only edges of a spanning forest leave a cell.  Groups of several parts are dealt anew
while labels still meet; then, where a band holds documents of different labels, those outside
its most frequent label are compared with all others of the band, and only edges between
different labels leave.  So a group makes about as many rows as
it has members, whatever its size, and no pair of candidates is left out.

With 28 bands of 5 coordinates a pair of similarity 0.85 shares no band with a
probability of about 7e-8, one of similarity 0.8 with about 1.5e-5.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairweave.llm._bytes import U64, mix, pair, runs, text_buffer, words
from fairweave.llm._shared import table, written
from fairweave.llm.graph import components

_PIECE = 1 << 19
#: Cells asked for (24 bytes each) up to which the list of candidates is broadcast.
_BROADCAST_CELLS = 600_000
#: Documents of a group of several parts that are compared with all of them.
_HUBS = 8
#: How often such a group is dealt to parts at most; after that its open bands are compared whole.
_DEALS = 5
_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("name", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SKETCH_SQL = "doc_id long, n_shingles long, node long, name long, bands array<long>"
_SETS = pa.schema([("c1", pa.int64()), ("c2", pa.int64()), ("c3", pa.int64()), ("node", pa.int64()), ("mark", pa.int64()), ("shingles", pa.binary())])
_SETS_SQL = "c1 long, c2 long, c3 long, node long, mark long, shingles binary"
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, shingle name) of the distinct shingles, sorted, and the sets' sizes."""
    n = len(offsets) - 1
    doc, _, name = words(raw, offsets)
    count = np.bincount(doc, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)[:-1]))
    gram, reach = name, 1
    for _ in range(width - 1):
        gram = pair(gram[: len(name) - reach], name[reach:])
        reach += 1
    whole = np.zeros(max(0, len(gram)), bool)
    if len(gram):
        whole = doc[: len(gram)] == doc[width - 1 :]
    d, s = doc[: len(gram)][whole], gram[whole]
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        value = name[first[short]]
        for k in range(1, width - 1):
            more = count[short] > k
            value[more] = pair(value[more], name[first[short][more] + k])
        d, s = np.concatenate((d, short)), np.concatenate((s, mix(value ^ count[short].astype(U64))))
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    d, s = d[new], s[new]
    return d, s, np.bincount(d, minlength=n)


def sketch(doc: np.ndarray, shingle: np.ndarray, n: int, bins: int) -> np.ndarray:
    """The sketches, one row for each of ``n`` documents; a coordinate is round << 40 | value."""
    empty = U64(2**64 - 1)
    out = np.full(n * bins, empty)
    base = doc * bins
    for i in range(2 * bins):
        x = mix(shingle ^ mix(np.array([i + 1], U64) * U64(0x9E3779B97F4A7C15)))
        value = (x & U64((1 << 40) - 1)) | U64(i << 40)
        slot = base + (((x >> U64(40)) * U64(bins)) >> U64(24)).astype(np.int64) if i < bins else base + (i - bins)
        np.minimum.at(out, slot, value)
        open_ = (out.reshape(n, bins) == empty).any(axis=1)[doc]
        if not open_.any():
            break
        if not open_.all():
            doc, shingle, base = doc[open_], shingle[open_], base[open_]
    return out.reshape(n, bins)


def _sketches(width: int, bands: int, rows: int):
    def work(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            ids = batch.column("doc_id")
            for i, j in runs(offsets, _PIECE):
                n = j - i
                doc, shingle, size = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                coordinate = sketch(doc, shingle, n, bands * rows).reshape(n, bands, rows)
                band = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=U64)), (n, bands))
                for r in range(rows):
                    band = pair(band, coordinate[:, :, r])
                cuts = np.concatenate(([0], np.cumsum(size)))
                sums = [np.concatenate((np.zeros(1, U64), np.cumsum(mix(shingle ^ U64(seed))))) for seed in (0xC1A55, 0x0B5E55)]
                node, name = (mix(x[cuts[1:]] - x[cuts[:-1]] + size.astype(U64)).view(np.int64) for x in sums)
                some = size > 0
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))), pa.int32()), pa.array(np.ascontiguousarray(band[some]).reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(i, n), pa.array(size.astype(np.int64)), pa.array(node), pa.array(name), lists], schema=_SKETCH)

    return work


def _sets(width: int):
    """Shingles of candidate documents, once for each cell that needs them."""

    def work(batches):
        for batch in batches:
            raw, offsets = text_buffer(batch.column("text"))
            node, mark = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "mark"))
            for i, j in runs(offsets, _PIECE):
                doc, shingle, size = shingle_sets(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)
                cuts = np.concatenate(([0], np.cumsum(size)))
                total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(shingle ^ U64(0xC1A55)))))
                name = mix(total[cuts[1:]] - total[cuts[:-1]] + size.astype(U64)).view(np.int64)
                for k in range(j - i):
                    if name[k] != node[i + k]:  # another row of the same id
                        continue
                    blob = shingle[cuts[k] : cuts[k + 1]].tobytes()
                    cells = batch.column("cells")[i + k].as_py()
                    for some in (cells[at : at + 64] for at in range(0, len(cells), 64)):
                        to = [(c["c1"], c["c2"], c["c3"], int(node[i + k]), int(mark[i + k]), blob) for c in some]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*to), _SETS.types)], schema=_SETS)

    return work


def _overlaps(name: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, shared) for all pairs i < j of ``n`` sets that share a name; names sorted, owners within."""
    dense = n <= 2048
    total = np.zeros(n * n if dense else 0, np.int32)
    codes, counts = [], []
    at, d = np.arange(len(name) - 1), 1
    while True:
        at = at[at + d < len(name)]
        at = at[name[at] == name[at + d]]
        if not len(at):
            break
        code, times = np.unique(owner[at] * n + owner[at + d], return_counts=True)
        if dense:
            total[code] += times.astype(np.int32)
        else:
            codes.append(code)
            counts.append(times)
        d += 1
    if dense:
        code = np.flatnonzero(total)
        shared = total[code]
    elif codes:
        code, number = np.unique(np.concatenate(codes), return_inverse=True)
        shared = np.bincount(number, weights=np.concatenate(counts)).astype(np.int64)
    else:
        code = shared = np.zeros(0, np.int64)
    return code // n, code % n, shared


def _linked(per_cent: int):
    """Edges that join the marks of linked sets: at most one less than the cell has marks."""

    def work(key, table):
        table = table.sort_by("node")
        node = table.column("node").to_numpy()
        keep = np.ones(len(node), bool)
        keep[1:] = node[1:] != node[:-1]
        table = table.filter(pa.array(keep))
        sets = [np.frombuffer(b, U64) for b in table.column("shingles").to_pylist()]
        size, n = np.array([len(s) for s in sets]), len(sets)
        name, owner = np.concatenate(sets), np.repeat(np.arange(n), size)
        order = np.lexsort((owner, name))
        i, j, shared = _overlaps(name[order], owner[order], n)
        link = 100 * shared >= per_cent * (size[i] + size[j] - shared)
        mark, of = np.unique(table.column("mark").to_numpy(), return_inverse=True)
        i, j = of[i[link]], of[j[link]]
        label = np.arange(len(mark))
        while True:
            new = label.copy()
            np.minimum.at(new, i, label[j])
            np.minimum.at(new, j, label[i])
            new = new[new]
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(mark)))
        return pa.table([pa.array(mark[moved]), pa.array(mark[label[moved]])], schema=_EDGES)

    return work


def _cell(*of) -> Column:
    return F.struct(*[(F.lit(x) if isinstance(x, int) else x).cast("long").alias(f"c{i + 1}") for i, x in enumerate(of)])


def _dealt(load: DataFrame, cell_shingles: int, cell_sets: int) -> tuple[DataFrame, int]:
    """``load`` (total, sets) with the parts that a group needs, and in how many cells the small groups are pooled."""
    load = load.withColumn("parts", F.ceil(F.greatest(F.col("total") / cell_shingles, F.col("sets") / cell_sets)).cast("long"))
    small = load.where("parts = 1").agg(F.sum("total").alias("t"), F.sum("sets").alias("s")).first()
    return load, max(48, math.ceil(2 * max((small.t or 0) / cell_shingles, (small.s or 0) / cell_sets)))


def _verified(source: DataFrame, asked: DataFrame, per_cent: int, width: int, name: str) -> DataFrame:
    """Edges between marks of linked sets; ``asked`` has doc_id, node, mark and the cells of each set."""
    asked = written(asked, name)
    if (asked.agg(F.sum(F.size("cells") + 2)).first()[0] or 0) <= _BROADCAST_CELLS:
        asked = F.broadcast(asked)
    sets = source.join(asked, source["doc_id"].eqNullSafe(asked["doc_id"])).select("text", "node", "mark", "cells").mapInArrow(_sets(width), _SETS_SQL)
    return sets.groupBy("c1", "c2", "c3").applyInArrow(_linked(per_cent), "a long, b long")


def _within_parts(source, member, pooled, salt, per_cent, width):
    """Edges within the parts of groups of candidates; ``salt`` deals documents to parts anew.

    A group of several parts has hubs, which are compared with all its parts.
    """
    member = member.withColumn("h", F.xxhash64("node", F.lit(salt)))
    hub = member.where("parts > 1").groupBy("group", F.pmod("h", F.lit(_HUBS))).agg(F.min(F.struct("h", "node"))["node"].alias("node")).select("node", F.lit(True).alias("hub"))
    every = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda p: _cell(F.col("group"), p, 0))
    own = F.array(_cell(F.col("group"), F.pmod(F.shiftright("h", 4), F.col("parts")), 0))
    pool = F.array(_cell(F.pmod(F.xxhash64("group"), F.lit(pooled)), -1, -1))
    cells = F.when(F.col("parts") == 1, pool).when(F.col("hub"), every).otherwise(own)
    asked = member.join(hub, "node", "left").select(F.col("rep").alias("doc_id"), "node", "mark", cells.alias("cells"))
    return _verified(source, asked, per_cent, width, "members")


def _merged(member: DataFrame, labels: DataFrame) -> DataFrame:
    """``member`` with each mark replaced by the label that it was given."""
    to = labels.select(F.col("node").alias("mark"), F.col("label").alias("to"))
    return member.join(to, "mark", "left").withColumn("mark", F.coalesce("to", "mark")).drop("to")


def _linked_groups(source, member, band, per_cent, width, cell_shingles, cell_sets):
    """(node, mark): equal marks for candidates that links join.

    Groups of several parts are dealt to parts several times, until hardly any labels meet;
    what is still apart then is compared exactly, band by band.
    """
    load, pooled = _dealt(member.groupBy("group").agg(F.sum("n").alias("total"), F.count("*").alias("sets")), cell_shingles, cell_sets)
    member = written(member.join(load.select("group", "parts"), "group").withColumn("mark", F.col("node")), "candidates")
    asked, marks = member, member.select("node", "mark")
    for salt in range(1, _DEALS + 1):
        labels = components(_within_parts(source, asked, pooled, salt, per_cent, width))
        marks = written(_merged(marks, labels), "marks")
        asked = member.drop("mark").where("parts > 1").join(marks, "node")
        several = asked.groupBy("group").agg((F.min("mark") < F.max("mark")).alias("open")).where("open").select("group")
        asked = written(asked.join(several, "group"), "open-groups")
        left = asked.count()
        if not left or salt > 1 and 50 * labels.where("node <> label").count() < left:
            break
    if left:
        marks = _merged(marks, components(_across_parts(source, band, member.drop("mark").where("parts > 1").join(marks, "node"), per_cent, width, cell_shingles, cell_sets)))
    return marks


def _across_parts(source, band, member, per_cent, width, cell_shingles, cell_sets):
    """Edges between labels that meet in a band and are not joined yet.

    A band whose documents have one label is done.  Of the others, each distinct set of documents
    is looked at once; documents outside its most frequent label are compared with all of it.
    """
    own = band.join(member.select("node", "rep", "n", "mark"), "node")
    marks = own.groupBy("band", "mark").agg(F.count("*").alias("sets"), F.sum("n").alias("total"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"))
    of = marks.groupBy("band").agg(F.max_by("mark", F.struct("sets", "mark")).alias("most"), F.max("sets").alias("top"), F.max_by("total", F.struct("sets", "mark")).alias("top_total"), F.count("*").alias("marks"), F.sum("sets").alias("sets"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum").alias("sum"))
    one = of.where("marks > 1").groupBy("sets", "total", "low", "high", "sum").agg(F.min_by(F.struct("band", "most", "top", "top_total"), "band").alias("one"))
    load, pooled = _dealt(one.select("one.*", "sets", "total"), cell_shingles, cell_sets)
    minor = F.ceil(F.greatest((F.col("total") - F.col("top_total")) / cell_shingles, (F.col("sets") - F.col("top")) / cell_sets, F.lit(1))).cast("long")
    load = written(load.withColumn("minors", minor).select("band", "most", "parts", "minors"), "open-bands")
    h = F.xxhash64("node", F.lit(1))
    count = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    pool = F.array(_cell(F.pmod(F.xxhash64("band"), F.lit(pooled)), -1, -1))
    rows = F.transform(count(F.col("minors")), lambda i: _cell(F.col("band"), i, F.pmod(h, F.col("parts"))))
    columns = F.transform(count(F.col("parts")), lambda j: _cell(F.col("band"), F.pmod(F.shiftright(h, 4), F.col("minors")), j))
    cells = F.when(F.col("parts") == 1, pool).when(F.col("mark") == F.col("most"), rows).otherwise(F.array_union(rows, columns))
    asked = own.join(load, "band").select("rep", "node", "mark", cells.alias("cells"))
    asked = asked.groupBy("rep", "node", "mark").agg(F.array_distinct(F.flatten(F.collect_list("cells"))).alias("cells"))
    return _verified(source, asked.withColumnRenamed("rep", "doc_id"), per_cent, width, "open-members")


def near_duplicates(docs: DataFrame, per_cent: int = 80, *, width: int = 5, bands: int = 28, rows: int = 5, cell_shingles: int = 400_000, cell_sets: int = 512) -> DataFrame:
    """Group documents whose sets of ``width``-word shingles have a similarity of ``per_cent`` or more.

    ``docs`` needs ``doc_id`` (integer) and ``text``; other columns are ignored.  Words lie
    between ASCII spaces and controls 9 to 13, A to Z lower-cased.  A text of fewer words is one
    shingle; a null text or one without words has an empty set and is linked with nothing.

    Returns one row per input row: doc_id, n_shingles, component_id (least doc_id reachable
    over links, itself included) and kept (doc_id = component_id).  Repeated rows are linked
    like any equal texts and share their id, so all of them are kept or none.  A null id gives
    way to any other; where no id is known the component is null and the row is kept.  An empty
    table gives no rows.

    ``cell_shingles`` and ``cell_sets`` bound the sets that one verification task holds.
    """
    spark: SparkSession = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = written(source.mapInArrow(_sketches(width, bands, rows), _SKETCH_SQL), "sketches")
    classes = written(
        sketched.where("n_shingles > 0").groupBy("node", "name").agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands")),
        "classes",
    )
    band = classes.select("node", F.explode("bands").alias("band"))
    shared = band.groupBy("band").agg(F.count("*").alias("times"), F.min("node").alias("b")).where("times > 1")
    shared = written(band.join(shared.select("band", "b"), "band"), "bands")
    groups = components(shared.select(F.col("node").alias("a"), "b").distinct())
    member = groups.withColumnRenamed("label", "group").join(classes.select("node", "rep", "n"), "node")
    linked = _linked_groups(source, member, shared.select("band", "node"), per_cent, width, cell_shingles, cell_sets)

    of = classes.select("node", "rep").join(linked, "node", "left").select("node", "rep", F.coalesce("mark", "node").alias("label"))
    least = of.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = of.join(least, "label").select("node", "component_id")
    out = sketched.select("doc_id", "n_shingles", "node").join(of, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents`` at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), 85)
