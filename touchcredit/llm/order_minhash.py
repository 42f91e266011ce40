"""Order MinHash fingerprints of documents, sensitive to edit distance (DataFrame functions only).

A text is a sequence of tokens: its words, and each code point of a script that
is written without spaces. Every ``k`` tokens in a row are a k-mer, numbered by
its earlier occurrences in the text, so repeated passages count as often as they
occur. One hash puts each (k-mer, occurrence) on a circle; the ``m`` signatures
start at ``m`` equidistant points of it, and each takes the first ``l`` k-mers
from there on, which are the ``l`` minimal ones under a rotation of the hash.
The selected k-mers are put back into their order in the text and hashed as one
tuple. Two texts agree in a signature if they share its minimal k-mers *and*
their order, so the share of equal signatures falls with the edit distance, also
where the k-mers stay the same and only move.

All of it happens inside a row with array functions, so no k-mer is shuffled.

``fingerprint_edits`` compares every document with its edited text, whose tail
is replaced by the head of the next document. Neighbours are found without a
window over the table: the sort keys' range heads (one key per shuffle
partition) cut it into chunks, the head of each chunk is dealt to the chunk
before it as well, and one window per chunk reads the next text and fingerprint.

Defined cases: a null text is empty; a text without tokens has the empty
fingerprint, which is like other empty ones only; with fewer than ``k`` tokens
the whole sequence is the one k-mer; with fewer than ``l`` k-mers each signature
holds all of them. Null ids come last in descending order; rows of one id follow
the hash of their text, equal rows are neighbours. A table of one document is
its own next; an empty table gives no rows. Only the id and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a k-mer, k-mers of a signature, signatures of a fingerprint (a power of two).
K, L, M = 2, 2, 64
#: Thai, Lao, Myanmar, Khmer, kana and Han code points, each a token of its own.
UNSPACED = r"[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\x{20000}-\x{3FFFF}]"
SPACES = r"[\x20\x09-\x0D]+"
#: A packed k-mer: 33 bits of hash above 30 bits of place (a text has fewer than 2^30 tokens).
_PLACE_BITS, _HASH_BITS = 30, 33
_PLACE, _HASH = (1 << _PLACE_BITS) - 1, (1 << _HASH_BITS) - 1
#: Heads compared one by one in each of the two steps that find a key's chunk.
_STRIDE = 64


def tokens(text: Column) -> Column:
    """The tokens of a text: words, and the code points of unspaced scripts one by one."""
    spread = F.when(text.rlike(UNSPACED), F.regexp_replace(text, f"({UNSPACED})", " $1 ")).otherwise(text)
    trimmed = F.btrim(F.coalesce(spread, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def signatures(df: DataFrame, text: Column, into: str, k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """``df`` with the array column ``into``: ``m`` signatures (long), none for a text without tokens."""
    if m < 2 or m & (m - 1):
        raise ValueError(f"m must be a power of two, not {m}")
    shift = _PLACE_BITS + _HASH_BITS - (m.bit_length() - 1)
    t, s, r, c = (f"__{into}_{x}" for x in ("tokens", "sorted", "ranked", "minimal"))
    tuple_of = ", ".join(["x", *(f"get({t}, i + {j})" for j in range(1, k))])
    pack = lambda of, place: f"shiftleft(xxhash64({of}) & {_HASH}L, {_PLACE_BITS}) | {place}"
    kept = df.columns
    # each step reads the one before more than once, which keeps the optimizer from inlining it into a lambda
    out = df.select("*", tokens(text).alias(t))
    out = out.select(*kept, F.expr(f"""
        sort_array(transform(slice({t}, 1, greatest(size({t}) - {k - 1}, least(size({t}), 1))),
                             (x, i) -> {pack(tuple_of, 'i')}))""").alias(s))
    same = f"shiftright({s}[i], {_PLACE_BITS}) = shiftright({s}[i - 1], {_PLACE_BITS})"
    out = out.select(*kept, s, F.expr(f"IF(size({s}) = 0, array(), filter(sequence(0, size({s}) - 1), i -> i = 0 OR NOT {same}))").alias(f"{s}_runs"))
    # k-mers of one run are equal and in text order: their index in the run is their occurrence number
    numbered = pack(f"shiftright(x, {_PLACE_BITS}), o", f"(x & {_PLACE})")
    out = out.select(*kept, F.expr(f"""
        sort_array(flatten(transform({s}_runs, (b, j) -> transform(
            slice({s}, b + 1, coalesce(get({s}_runs, j + 1), size({s})) - b), (x, o) -> {numbered}))))""").alias(r))
    # the first l k-mers of each m-th of the circle are all that any signature can need
    out = out.select(*kept, F.expr(f"""
        filter({r}, (x, i) -> i < {l} OR shiftright({r}[i - {l}], {shift}) <> shiftright(x, {shift}))""").alias(c))
    first = f"""concat(flatten(transform({c}, (x, i) -> array_repeat(i, CAST(shiftright(x, {shift})
                    - IF(i = 0, -1L, shiftright({c}[i - 1], {shift})) AS int)))),
                array_repeat(0, IF(size({c}) = 0, 0, {m - 1} - CAST(shiftright(element_at({c}, -1), {shift}) AS int))))"""
    turned = f"shiftleft(x & {_PLACE}, {_HASH_BITS}) | shiftright(x, {_PLACE_BITS})"
    return out.select(*kept, F.expr(f"""
        transform({first}, i -> xxhash64(transform(sort_array(transform(
            slice(concat({c}, {c}), i + 1, least({l}, size({c}))), x -> {turned})), x -> x & {_HASH})))""").alias(into))


def as_text(signature: Column) -> Column:
    """A fingerprint as lowercase hex, 8 digits a signature."""
    return F.lower(F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures; two empty fingerprints are alike."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda x: x))
    return F.when(F.greatest(F.size(a), F.size(b)) == 0, 1.0).otherwise(equal / F.greatest(F.size(a), F.size(b)))


def sort_key(id_col: str, text: Column) -> Column:
    """Text that sorts as descending id, null last, then the text's hash."""
    digits = lambda x: F.lpad(F.hex(x), 16, "0")
    falling = F.bitwise_not(F.col(id_col)).bitwiseXOR(F.lit(-1 << 63))
    return F.concat(F.when(F.col(id_col).isNull(), "1").otherwise("0"), F.coalesce(digits(falling), F.lit("")), digits(F.xxhash64(text)))


def range_heads(rows: DataFrame, key: str, ranges: int) -> list[str]:
    """The least key of each of at most ``ranges`` ranges of the rows: as many strings as there are shuffle partitions."""
    parts = rows.select(key).repartitionByRange(ranges, key).groupBy(F.spark_partition_id()).agg(F.min(key).alias("head"))
    return sorted({r["head"] for r in parts.collect()})


def chunk_of(key: Column, heads: list[str]) -> Column:
    """How many heads are at or below the key, found in two short steps."""
    coarse, every = F.lit(heads[::_STRIDE]), F.lit(heads)
    block = F.greatest(F.size(F.filter(coarse, lambda h: h <= key)) - 1, F.lit(0)) * _STRIDE
    return F.greatest(block + F.size(F.filter(F.slice(every, block + 1, _STRIDE), lambda h: h <= key)), F.lit(1))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """(doc_id, n_chars, fingerprint) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return signatures(rows, F.col("text"), "signatures", k, l, m).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), as_text(F.col("signatures")).alias("fingerprint"))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, l: int = L,  # noqa: E741
                      m: int = M, ranges: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last third replaced by as many code points from the start of the next document, in
    descending id; the first document follows the last. ``ranges``: chunks of the table, the session's shuffle
    partitions by default.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", sort_key("doc_id", F.col("text")).alias("key"))
    heads = range_heads(rows, "key", ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))) or [""]
    own = signatures(rows.withColumn("chunk", chunk_of(F.col("key"), heads)), F.col("text"), "own", k, l, m)
    before = F.when(F.col("chunk") == 1, len(heads)).otherwise(F.col("chunk") - 1)
    place = lambda chunk, guest: F.struct(chunk.cast("int").alias("chunk"), F.lit(guest).alias("guest"))
    is_head = F.element_at(F.lit(heads), F.col("chunk").cast("int")) == F.col("key")
    dealt = own.select("doc_id", "text", "key", "own", F.explode(F.when(
        is_head, F.array(place(F.col("chunk"), False), place(before, True))).otherwise(F.array(place(F.col("chunk"), False)))).alias("at"))
    falling = Window.partitionBy("at.chunk").orderBy("at.guest", "key")
    pairs = (dealt.select("doc_id", "text", "own", "at.guest", F.lead("text").over(falling).alias("next_text"),
                          F.lead("own").over(falling).alias("next_own")).filter("NOT guest"))
    n, cut = F.char_length("text"), F.floor(F.char_length("text") / 3).cast("int")
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)).alias("edited"))
    pairs = signatures(pairs, F.col("edited"), "edited_own", k, l, m)
    return pairs.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edited_own")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
