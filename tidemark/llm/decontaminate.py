"""Benchmark passages in training documents, by a broadcast hash set of test n-grams.

Only built-in column functions. Items and documents are cut into normalised words. Every window of
an item goes into the set; an item shorter than a window is one window as a whole.

A document's words become 64-bit hashes, and a window the hash of its words' hashes. A place is a
candidate if its first and last word stand together at the ends of a window of the set, and then
the hash of the whole window is in the set. Only candidates are spelt out as words, and joined to the set on the
words themselves, so a hit is verified word by word. So a document never holds its windows as text.

A set of ``PROBED`` windows at most goes into the plan, where each row asks it without a join;
rows without a candidate are then decided at once. Of a larger set the hashes are joined to those
of all windows, and only documents with a candidate are read again. Up to ``BROADCAST_BYTES`` the set
is broadcast, beyond that it is joined by shuffle. The result is the same in all cases.

Defined results: a null text has no words; a null item id counts as an empty one; rows with equal
id and text get equal results, rows with equal id and different texts their own; an empty benchmark
hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import apart, ascii_lower, cut, own_name, text_key, unused

WINDOW = 10
#: What stands between words: ASCII other than letters and digits.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[0-9A-Za-z\u0080-\x{10FFFF}]+"
#: The most a set may take, in bytes of its windows, to be sent to all executors.
BROADCAST_BYTES = 32 << 20
#: The most windows whose hashes go into the plan.
PROBED = 50_000
#: The most characters of windows that go into the plan to decide rows by themselves.
LISTED = 4 << 20
SPELT = "array<struct<start:int,size:int,gram:string>>"


def words(text: Column) -> Column:
    """Words as they are written; lowering A-Z moves no border."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), APART, -1), "")


def _word_hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda w: F.xxhash64(ascii_lower(w)))


def _windows(tokens: Column, starts: Column, size: int) -> Column:
    """(start, size, gram) of the windows of the given size at the given starts."""
    return F.transform(
        starts,
        lambda i: F.struct(
            i.cast("int").alias("start"),
            F.lit(size).alias("size"),
            ascii_lower(F.array_join(F.slice(tokens, i + 1, F.lit(size)), " ")).alias("gram"),
        ),
    ).cast(SPELT)


def _starts(length: Column, size: int) -> Column:
    """Starts of all windows of a size."""
    last = length - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _listed(values) -> str:
    return ", ".join(f"{v}L" for v in sorted(set(values)))


def benchmark_grams(benchmark: DataFrame, id_col: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, size, gram) of every window of every item."""
    items = benchmark.select(
        F.coalesce(benchmark[id_col].cast("string"), F.lit("")).alias("item"),
        words(ascii_lower(benchmark[text])).alias("tokens"),
    )
    tokens = F.col("tokens")
    short = F.array(
        F.struct(F.lit(0).alias("start"), F.size(tokens).alias("size"), F.array_join(tokens, " ").alias("gram"))
    ).cast(SPELT)
    grams = F.when(F.size(tokens) < window, short).otherwise(_windows(tokens, _starts(F.size(tokens), window), window))
    items = items.filter(F.size(tokens) > 0).select("item", F.explode(grams).alias("w"))
    return items.select("item", "w.size", "w.gram").distinct()


class GramSet:
    """The windows of a benchmark, written once, and how documents are joined to them."""

    def __init__(self, benchmark: DataFrame, id_col: str, text: str, window: int):
        grams = benchmark_grams(benchmark, id_col, text, window)
        hashes = _word_hashes(F.split("gram", " "))
        self.grams = cut(
            grams.groupBy("size", "gram")
            .agg(F.sort_array(F.collect_set("item")).alias("items"))
            .withColumn("hashes", hashes)
            .select(
                "size", "gram", "items",
                F.xxhash64("hashes").alias("hash"),
                F.element_at("hashes", 1).bitwiseXOR(F.shiftleft(F.element_at("hashes", -1), 1)).alias("ends"),
            )
        )
        size = F.octet_length("gram") + F.octet_length(F.array_join("items", "")) + 16 * F.size("items") + 64
        sums = self.grams.groupBy("size").agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).collect()
        self.sizes = sorted(r["size"] for r in sums)
        self.small = sum(r["bytes"] for r in sums) <= BROADCAST_BYTES
        self.probed = None
        if self.small and sum(r["n"] for r in sums) <= PROBED:
            self.probed = self.grams.select("size", "hash", "ends", "gram").collect()

    def _candidates(self, size: int) -> Column:
        """Starts of windows whose hash is in the set, from the column ``hashes``."""
        of_size = [r for r in self.probed if r["size"] == size]
        ends, whole = (_listed(r[c] for r in of_size) for c in ("ends", "hash"))
        # What the window ends with, beside what it begins with; null behind the last window.
        ahead = f"slice(hashes, {size}, size(hashes))"
        pairs = f"zip_with(hashes, {ahead}, (a, b) -> a ^ shiftleft(b, 1))"
        begun = f"filter(transform({pairs}, (p, i) -> if(p IN ({ends}), i, null)), i -> i IS NOT NULL)"
        return F.expr(f"filter({begun}, i -> xxhash64(slice(hashes, i + 1, {size})) IN ({whole}))")

    def probe(self, rows: DataFrame, text: Column) -> DataFrame:
        """Add n_words and spelt, the windows of the text whose hash is in the set, to rows without such names."""
        source = F.coalesce(text, F.lit(""))
        plain = F.octet_length(source) == F.char_length(source)
        # Text in ASCII is lowered at once, other text word by word.
        given = rows.columns
        rows = rows.withColumns({"plain": plain, "tokens": words(F.when(plain, F.lower(source)).otherwise(source))})
        tokens = F.col("tokens")
        hashes = F.when(F.col("plain"), F.transform(tokens, lambda w: F.xxhash64(w))).otherwise(_word_hashes(tokens))
        rows = rows.withColumns({"n_words": F.size("tokens").cast("long"), "hashes": hashes})
        rows = rows.withColumns({f"at_{n}": self._candidates(n) for n in self.sizes})
        every = F.concat(*[_windows(tokens, F.col(f"at_{n}"), n) for n in self.sizes])
        # A generator of one row, in its outer form: a filter on what it makes stays behind it. Moved
        # before it, the filter would work out the hashes again for each window.
        made = F.explode_outer(F.array(F.struct("n_words", every.alias("spelt")))).alias("made")
        return rows.select(*given, made).select(*given, "made.n_words", "made.spelt")

    def spelt(self, docs: DataFrame, id_col: str, text: str) -> DataFrame:
        """(id, key, n_words, spelt): the windows of each document whose hash is in the set."""
        rows = docs.select(docs[id_col].alias("id"), text_key(docs[text]).alias("key"), docs[text].alias("text"))
        none = F.array().cast(SPELT)
        if self.sizes and self.probed is not None:
            return self.probe(rows, F.col("text")).drop("text")
        rows = rows.select("id", "key", words(ascii_lower(F.col("text"))).alias("tokens"))
        rows = rows.withColumn("n_words", F.size("tokens").cast("long"))
        tokens = F.col("tokens")
        if not self.sizes:
            return rows.select("id", "key", "n_words", none.alias("spelt"))
        hashes = rows.select("id", "key", _word_hashes(tokens).alias("hashes"))

        def hashed(n: int) -> Column:
            found = lambda i: F.xxhash64(F.slice("hashes", i + 1, F.lit(n))).alias("hash")
            one = lambda i: F.struct(i.alias("start"), F.lit(n).alias("size"), found(i))
            return F.transform(_starts(F.size("hashes"), n), one)

        every = F.concat(*[hashed(n) for n in self.sizes])
        seen = hashes.select("id", "key", F.explode(every).alias("w")).select("id", "key", "w.*")
        known = self.grams.select("size", "hash").distinct()
        met = seen.join(F.broadcast(known) if self.small else known, ["size", "hash"], "left_semi")
        # Rows of equal id and text agree, so places are told apart once.
        met = met.groupBy("id", "key").agg(F.collect_set(F.struct("start", "size")).alias("places"))
        met = met.select(F.col("id").alias("its_id"), F.col("key").alias("its_key"), "places")
        rows = rows.join(met, rows["id"].eqNullSafe(met["its_id"]) & (rows["key"] == met["its_key"]), "left")

        def window(p: Column) -> Column:
            gram = ascii_lower(F.array_join(F.slice(tokens, p["start"] + 1, p["size"]), " "))
            return F.struct(p["start"].alias("start"), p["size"].alias("size"), gram.alias("gram"))

        spelt = F.coalesce(F.transform("places", window).cast(SPELT), none)
        return rows.select("id", "key", "n_words", spelt.alias("spelt"))

    def join(self, rows: DataFrame, how: str) -> DataFrame:
        """Rows with a gram, and the items that hold it."""
        chosen = self.grams.select("gram", "items")
        return rows.join(F.broadcast(chosen) if self.small else chosen, "gram", how)


def hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, key, start, size, gram, items) of windows that are in the set."""
    grams = GramSet(benchmark, item_col, item_text, window)
    # The outer form: for the plain one Spark infers a filter that spells the windows out once more.
    seen = grams.spelt(docs, id_col, text).select("id", "key", F.explode_outer("spelt").alias("w"))
    return grams.join(seen.select("id", "key", "w.start", "w.size", "w.gram"), "inner")


def _places(spans: Column) -> Column:
    """Distinct word numbers under spans of (start, size)."""
    return F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, key, n_words, n_hit, items) for each row; items are ids as strings, sorted."""
    grams = GramSet(benchmark, item_col, item_text, window)
    seen = grams.spelt(docs, id_col, text).select("id", "key", "n_words", F.posexplode_outer("spelt").alias("at", "w"))
    seen = grams.join(seen.select("id", "key", "n_words", "at", "w.start", "w.size", "w.gram"), "left")
    # Of every document its first row stays, so that one without hits is not lost.
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    hit = F.col("items").isNotNull()
    found = (
        seen.filter(first | hit)
        .groupBy("id", "key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sum(F.when(first, 1).otherwise(0)).cast("int").alias("copies"),
            F.collect_set(F.when(hit, F.struct("start", "size"))).alias("hits"),
            F.collect_set("items").alias("items"),
        )
    )
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return found.select(
        "id",
        "key",
        "n_words",
        F.size(_places(F.col("hits"))).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(F.flatten("items"))).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows without any hit, with their columns.

    Where the set is in the plan, each row is decided by itself: its candidates are compared with the
    windows word by word, and no text is shuffled.
    """
    grams = GramSet(benchmark, item_col, item_text, window)
    if not grams.sizes:
        return docs
    if grams.probed is not None and sum(len(r["gram"]) for r in grams.probed) <= LISTED:
        rows, names = apart(docs)
        rows = grams.probe(rows, F.col(own_name(names, text)))
        # Windows hold letters, digits, signs beyond ASCII and blanks alone, so they need no escape.
        known = ", ".join(f"'{g}'" for g in sorted({r["gram"] for r in grams.probed}))
        clean = rows.filter(~F.expr(f"exists(spelt, w -> w.gram IN ({known}))"))
        return clean.select(*[F.col(inner).alias(c) for c, inner in names.items()])
    seen = grams.spelt(docs, id_col, text).select("id", "key", F.explode_outer("spelt").alias("w"))
    gone = grams.join(seen.select("id", "key", "w.gram"), "inner")
    gone = gone.select(F.col("id").alias("__id"), F.col("key").alias("__key")).distinct()
    key = unused(docs, "__own")
    keyed = docs.withColumn(key, text_key(docs[text]))
    on = keyed[id_col].eqNullSafe(gone["__id"]) & (keyed[key] == gone["__key"])
    return keyed.join(gone, on, "left_anti").select(*[keyed[c] for c in docs.columns])


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """All rows, their texts without the words under hits; what stands between words stays."""
    found = hits(docs, benchmark, id_col, text, **names)
    gone = found.groupBy("id", "key").agg(_places(F.collect_set(F.struct("start", "size"))).alias("__gone"))
    gone = gone.withColumnsRenamed({"id": "__id", "key": "__key"})
    key = unused(docs, "__own")
    keyed = docs.withColumn(key, text_key(docs[text]))
    on = keyed[id_col].eqNullSafe(gone["__id"]) & (keyed[key] == gone["__key"])
    both = keyed.join(gone, on, "left")
    own = words(both[text])
    gaps = F.split(both[text], WORD, -1)
    # Words and places as one list: of each number the word goes if a place has it too.
    stays = F.array_except(F.sequence(F.lit(0), F.size(own) - 1), F.col("__gone"))
    kept = F.transform(stays, lambda i: F.struct(i.alias("at"), F.get(own, i).alias("word")))
    lost = F.transform("__gone", lambda i: F.struct(i.alias("at"), F.lit("").alias("word")))
    ordered = F.transform(F.array_sort(F.concat(kept, lost)), lambda p: p["word"])
    parts = F.zip_with(gaps, ordered, lambda g, w: F.concat(g, F.coalesce(w, F.lit(""))))
    cleaned = F.when(F.col("__gone").isNotNull(), F.array_join(parts, "")).otherwise(both[text])
    return both.select(*[cleaned.alias(c) if c == text else keyed[c] for c in docs.columns])
