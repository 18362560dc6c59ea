"""Document fingerprints: a homomorphic multiset hash of paragraphs, in DataFrame functions only.

A paragraph is a line, without its newline; a text has one more than it has newlines. A paragraph's vector has two
parts. The wide part is made of two 64-bit hashes of the paragraph, in four fields modulo 2^32. The likeness part is the
sum of the vectors of its pieces: at most four words each, white space included, so that every character is in one
piece; a piece's vector holds the 128 bits of two hashes, one a lane. A fingerprint is the sum of its paragraphs'
vectors, with the numbers of paragraphs and pieces: it does not depend on the order of the paragraphs, and those of
single paragraphs can be added to it and taken from it (`plus`, `minus`). Equal multisets have equal fingerprints.

Lanes also tell how alike two documents are. With bits read as +1 and -1, the squared difference of two fingerprints,
averaged over the lanes, estimates the number of pieces that only one has (the square of it where a piece is repeated), so
that likeness = 1 - difference / all pieces, with a relative error of the difference of about 12 %.

Paragraphs and pieces are exploded and summed by compiled aggregates, before rows are shuffled. Two 32-bit lane sums
travel in one long until they are printed modulo 2^16. Nulls: a null text is the empty text, which is one empty
paragraph; a null id comes below all ids. Rows that share an id each get a row; as someone's next document the one with
the greatest text stands for them. A long text is a longer sum. Repeated rows are summed together and divided again (of
one row and its pieces there may be 2^32 in all). An empty table gives an empty result. Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.llm.common import NULL_ID, id_key, partitions, stored, text_of

PIECE = r"(?:\S{1,64}+[^\S\n]*+){1,4}+|[^\S\n]++"
LANES = 128
_TWO = (1 << 32) | 1
_LOW = (1 << 32) - 1


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def piece_hash(piece: Column, salt: int) -> Column:
    """The salt comes first: xxhash64 seeds each argument's hash with that of those before it."""
    return F.xxhash64(F.lit(salt), piece)


def elements(text: Column) -> Column:
    """What a text's vectors are summed from: (kind, a, b) with two hashes; kind 0 is the row itself, 1 a piece, 2 a paragraph."""
    def made(items: Column, kind: int) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("kind"), piece_hash(x, 2 * kind - 1).alias("a"), piece_hash(x, 2 * kind).alias("b")))

    row = F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b")))
    return F.concat(row, made(pieces(text), 1), made(F.split(text, "\n", -1), 2))


def summed(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, rows: how many rows there are of them, f: the fingerprint of their text), for rows whose keys tell their texts apart.

    f: struct<n: pieces, m: paragraphs, v: LANES / 2 longs, two lane sums in each, w: 4 sums of halves>."""
    each = rows.select(*keys, F.explode(elements(F.col(text))).alias("e")).select(*keys, "e.kind", "e.a", "e.b")
    piece, none = F.col("kind") == 1, F.lit(0).cast("long")
    bits, wide = [F.when(piece, F.col(h)).otherwise(none) for h in "ab"], [F.when(F.col("kind") == 2, F.col(h)).otherwise(none) for h in "ab"]
    sums = [F.sum(F.shiftrightunsigned(h, j).bitwiseAND(F.lit(_TWO))) for h in bits for j in range(LANES // 4)]
    halves = [F.sum(x) for h in wide for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(_LOW)))]
    counts = [F.count_if(F.col("kind") == k).alias(c) for k, c in ((0, "rows"), (1, "n"), (2, "m"))]
    found = each.groupBy(*keys).agg(*counts, *(x.alias(f"v{i}") for i, x in enumerate(sums)), *(x.alias(f"w{i}") for i, x in enumerate(halves)))
    one = lambda c: F.expr(f"{c} div rows")
    low = lambda c: one(c).bitwiseAND(F.lit(_LOW))
    f = F.struct(one("n").alias("n"), one("m").alias("m"), F.array(*(one(f"v{i}") for i in range(len(sums)))).alias("v"), F.array(*(low(f"w{i}") for i in range(len(halves)))).alias("w"))
    return found.select(*keys, "rows", f.alias("f"))


def _fields(x: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(_LOW))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together."""
    return _both(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b."""
    return _both(a, b, -1)


def _both(a: Column, b: Column, sign: int) -> Column:
    def packed(x: Column, y: Column) -> Column:
        (xh, xl), (yh, yl) = _fields(x), _fields(y)
        high = (xh + sign * yh).bitwiseAND(F.lit(_LOW))
        return F.shiftleft(high, 32).bitwiseOR((xl + sign * yl).bitwiseAND(F.lit(_LOW)))

    wide = F.zip_with(a["w"], b["w"], lambda x, y: (x + sign * y).bitwiseAND(F.lit(_LOW)))
    return F.struct((a["n"] + sign * b["n"]).alias("n"), (a["m"] + sign * b["m"]).alias("m"), F.zip_with(a["v"], b["v"], packed).alias("v"), wide.alias("w"))


def printed(f: Column) -> Column:
    """Hexadecimal: the number of paragraphs, the wide part, the number of pieces, each lane modulo 2^16."""
    def eight(x: Column) -> Column:
        return F.lpad(F.hex(x), 8, "0")

    def two(x: Column) -> Column:
        high, low = _fields(x)
        return eight(high.bitwiseAND(F.lit(0xFFFF)) * 65536 + low.bitwiseAND(F.lit(0xFFFF)))

    return F.lower(F.concat(eight(f["m"]), F.array_join(F.transform(f["w"], eight), ""), eight(f["n"]), F.array_join(F.transform(f["v"], two), "")))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal fingerprints."""
    shift = a["n"] - b["n"]

    def squares(x: Column, y: Column) -> Column:
        (xh, xl), (yh, yl) = _fields(x), _fields(y)
        high, low = 2 * (xh - yh) - shift, 2 * (xl - yl) - shift
        return (high * high + low * low).cast("double")

    apart = F.aggregate(F.zip_with(a["v"], b["v"], squares), F.lit(0.0), lambda acc, x: acc + x) / LANES
    both = a["n"] + b["n"]
    return F.when(both == 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - apart / both)))


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, x, y, body): x and y name the body."""
    body = text_of(text_col)
    return docs.select(id_key(id_col).alias("key"), piece_hash(body, 5).alias("x"), piece_hash(body, 6).alias("y"), body.alias("body"))


def _repeated(df: DataFrame) -> DataFrame:
    return df.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int")))).drop("again", "rows")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, f, fingerprint) of each row."""
    rows = _named(docs, id_col, text_col).withColumn("n_chars", F.length("body").cast("long"))
    found = _repeated(summed(rows, ["key", "x", "y", "n_chars"], "body"))
    return found.select(F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), "n_chars", "f", printed(F.col("f")).alias("fingerprint"))


def neighbours(ids: DataFrame) -> tuple[DataFrame, bool]:
    """From (key, third): (key, to, need): key's text goes to document `to`, the first `need` characters of it; and
    whether keys repeat. Ids are sorted in ranges; only each range's first row visits the driver."""
    spark = ids.sparkSession
    keys = ids.groupBy("key").agg(F.max("third").alias("third"), F.count("*").alias("rows"))
    ranged = stored(keys.repartitionByRange(partitions(spark), "key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id()), "ids")
    firsts = sorted(ranged.groupBy("part").agg(F.min("key").alias("key"), F.min_by("third", "key").alias("third"), F.max("rows").alias("rows")).collect())
    after = [(p["part"], n["key"], n["third"]) for p, n in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    bounds = F.broadcast(spark.createDataFrame(after, "part int, next_key long, next_third long"))
    order = Window.partitionBy("part").orderBy("key")
    out = ranged.withColumn("to", F.lead("key").over(order)).withColumn("need", F.lead("third").over(order)).join(bounds, "part", "left")
    last = F.col("to").isNull()
    return out.select("key", F.when(last, F.col("next_key")).otherwise(F.col("to")).alias("to"), F.when(last, F.col("next_third")).otherwise(F.col("need")).alias("need")), any(r["rows"] > 1 for r in firsts)


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document and its edited text (the last third replaced from the next document, by descending id): doc_id, n_chars,
    edited_sha256, f, edited_f, next_f."""
    rows = _named(docs, id_col, text_col)
    serve, repeated = neighbours(rows.select("key", F.floor(F.length("body") / 3).cast("long").alias("third")))
    # texts are dealt by key once, for the sums and both joins, which all read that exchange; own fingerprints don't move
    rows = rows.repartition("key")
    mine = summed(rows, ["key", "x", "y"], "body")
    given = rows.join(serve, "key").select(F.col("to").alias("key"), F.col("key").alias("next"), F.col("x").alias("next_x"), F.col("y").alias("next_y"), F.left(F.col("body"), F.col("need").cast("int")).alias("lead"), *(["body"] if repeated else []))
    if repeated:
        given = given.groupBy("key").agg(F.max_by(F.struct("next", "next_x", "next_y", "lead"), "body").alias("g")).select("key", "g.*")
    third = F.floor(F.length("body") / 3).cast("int")
    edited = F.concat(F.left(F.col("body"), F.length("body") - third), F.left(F.col("lead"), third))
    names = ["key", "x", "y", "n_chars", "sha", "next", "next_x", "next_y"]
    texts = rows.join(given, "key").withColumn("edited", edited).withColumns({"n_chars": F.length("body").cast("long"), "sha": F.unhex(F.sha2("edited", 256))})
    changed = summed(texts.select(*names, "edited"), names, "edited").withColumnRenamed("f", "edited_f")
    # joined by key alone, as the texts are dealt already: only the next documents' fingerprints move
    same = lambda *pairs: [F.col(a).bitwiseXOR(F.col(b)) == 0 for a, b in pairs]  # noqa: E731  no join keys
    own = mine.select("key", F.col("x").alias("own_x"), F.col("y").alias("own_y"), "f")
    following = mine.join(serve, "key").select(F.col("to").alias("key"), F.col("key").alias("from"), F.col("x").alias("from_x"), F.col("y").alias("from_y"), F.col("f").alias("next_f"))
    out = changed.join(own, "key").join(following, "key")
    for condition in same(("x", "own_x"), ("y", "own_y"), ("next", "from"), ("next_x", "from_x"), ("next_y", "from_y")):
        out = out.where(condition)
    return _repeated(out).select(F.when(F.col("key") != NULL_ID, F.col("key")).alias("doc_id"), "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "f", "edited_f", "next_f")
