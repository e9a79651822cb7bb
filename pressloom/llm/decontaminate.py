"""Benchmark decontamination with Wu-Manber multi-pattern search over words.

The patterns are the windows of ``window`` consecutive words of the benchmark items; an item of
fewer words is one shorter window. Windows of one length m form one pattern set. Its shift table
maps a block of two consecutive words to how far the scan may jump when that block stands at the
end of the current position: blocks that no pattern holds allow m - 1 words at once. Where the
shift is zero, the block picks a bucket of patterns that end in it, the first block narrows it
down, and the words are compared directly.

The benchmark is the query set: it is read to the driver in blocks of at most ``block_bytes`` of
text, and every block is searched in all documents. One block is the normal case and needs no
shuffle at all; with more, the hits of a document are put together by an aggregate.

Edge cases: null or wordless texts have no words and no hits; a null or wordless item has no
window; rows of one item_id count as one item, and an item without an id marks words but is not
counted; repeated documents get equal rows; extra columns are ignored or passed through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.llm.common import as_bytes, batchwise, fresh, merge_spans

# A-Z to a-z; 0-9, a-z and all bytes of 0x80 and above are kept; the rest divides words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

Block = tuple[bytes, ...]
Item = tuple[object, list[bytes]]


def split_words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(WORD_BYTES).split()


class WuManber:
    """Shift table and buckets for windows of one length in words.

    A window is kept as its item and offset, so the words themselves are held once.
    """

    def __init__(self, m: int, items: list[Item]):
        self.m = m
        self.b = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict[Block, int] = {}
        self.buckets: dict[Block, dict[Block, list[tuple[object, list[bytes], int]]]] = {}
        for item, words in items:
            n = len(words)
            blocks = [tuple(words[i:i + b]) for i in range(n - b + 1)]
            for i, block in enumerate(blocks):
                # The latest end that the block has in any window of the item.
                latest = min(m, i + b)
                self.shift[block] = min(self.shift.get(block, self.far), m - latest)
                if i + b >= m:
                    start = i + b - m
                    self.buckets.setdefault(block, {}).setdefault(blocks[start], []).append((item, words, start))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[object]]]:
        """Start and items of every occurrence, from left to right."""
        m, b, far, shift, buckets = self.m, self.b, self.far, self.shift, self.buckets
        end, n = m, len(words)
        while end <= n:
            block = tuple(words[end - b:end])
            jump = shift.get(block, far)
            if jump:
                end += jump
                continue
            start = end - m
            near = buckets[block].get(tuple(words[start:start + b]), ())
            here = words[start:end] if near else ()
            found = [item for item, other, at in near if other[at:at + m] == here]
            if found:
                yield start, found
            end += 1


def build_searches(items: list[tuple[object, bytes | None]], window: int) -> list[WuManber]:
    by_length: dict[int, list[Item]] = {}
    for item, text in items:
        words = split_words(text)
        if words:
            by_length.setdefault(min(window, len(words)), []).append((item, words))
    return [WuManber(m, group) for m, group in sorted(by_length.items())]


def search(searches: list[WuManber], words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Merged spans of hit words (end exclusive) and the items that occur."""
    raw, found = [], set()
    for one in searches:
        for start, items in one.find(words):
            raw.append((start, start + one.m))
            found.update(i for i in items if i is not None)
    return merge_spans(raw), found


def contaminated(n_words: int, n_hit: int) -> bool:
    """One word in twenty or more."""
    return n_hit > 0 and 20 * n_hit >= n_words


def benchmark_blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, bytes | None]]]:
    """Items in blocks of bounded text, each read to the driver on its own."""
    held = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text"))
    total = held.agg(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0
    count = max(1, -(-total // block_bytes))
    for k in range(count):
        part = held if count == 1 else held.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        yield [(r["item"], None if r["text"] is None else r["text"].encode()) for r in part.toLocalIterator()]


def _shared(benchmark: DataFrame, item: str, text: str, window: int, block_bytes: int) -> list:
    """The searches of each block as a broadcast of bounded size."""
    share = benchmark.sparkSession.sparkContext.broadcast
    return [share(build_searches(items, window)) for items in benchmark_blocks(benchmark, item, text, block_bytes)]


SPANS = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
HITS = "n_words bigint, spans array<struct<s:int,e:int>>, items array<string>"


def _hits(docs: DataFrame, searches, carried: list[str], text: str) -> DataFrame:
    """Carried columns, then n_words, spans and items of each row."""
    picked = docs.select(*carried, F.col(text).alias("_text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in picked.dtypes[:-1]) + ", " + HITS

    def run(batches):
        tables = searches.value
        for batch in batches:
            counts, spans, items = [], [], []
            for raw in as_bytes(batch.column(len(carried))):
                words = split_words(raw)
                hit, found = search(tables, words)
                counts.append(len(words))
                spans.append([{"s": s, "e": e} for s, e in hit])
                items.append(sorted(map(str, found)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.string()))],
                [*carried, "n_words", "spans", "items"])

    return batchwise(picked, run, schema)


def find_hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
              item_text: str = "text", window: int = 13, block_bytes: int = 2 << 20) -> DataFrame:
    """Per row: doc_id, n_words, spans of hit words, and the ids (as text) of the items that occur."""
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_body"))
    parts = _shared(benchmark, item, item_text, window, block_bytes)
    if len(parts) == 1:
        return _hits(named, parts[0], ["doc_id"], "_body")
    # Rows of one id and one text have equal hits: each such group is brought to one row per
    # block, then to one row, and given out as often as it was there.
    hashed = named.withColumn("_md5", F.md5("_body"))
    found = None
    for k, one in enumerate(parts):
        part = _hits(hashed, one, ["doc_id", "_md5"], "_body").withColumn("_block", F.lit(k))
        found = part if found is None else found.unionByName(part)
    by_block = found.groupBy("doc_id", "_md5", "_block").agg(
        F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in ("n_words", "spans", "items")])
    whole = by_block.groupBy("doc_id", "_md5").agg(
        F.max("_rows").alias("_rows"), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    out = whole.select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1).cast("bigint"), "_rows")).alias("_n")).drop("_n")

    def merge(batches):
        for batch in batches:
            spans = [merge_spans([(x["s"], x["e"]) for x in row]) for row in batch.column(2).to_pylist()]
            merged = pa.array([[{"s": s, "e": e} for s, e in row] for row in spans], SPANS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], merged, batch.column(3)], batch.schema.names)

    return batchwise(out, merge, out.schema)


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    hits = find_hits(docs, benchmark, **options)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + (x["e"] - x["s"]))
    counted = hits.withColumn("n_hit", n_hit)
    return counted.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
                      window: int = 13, block_bytes: int = 2 << 20) -> DataFrame:
    """The rows that are not contaminated, with their own columns."""
    parts = _shared(benchmark, item, item_text, window, block_bytes)
    if len(parts) > 1:
        md5 = fresh(docs, "_md5")
        options = dict(text=text, item=item, item_text=item_text, window=window, block_bytes=block_bytes)
        marked = docs.withColumn(md5, F.md5(text))
        bad = report(marked, benchmark, key=md5, **options).where("contaminated").select(F.col("doc_id").alias(md5)).distinct()
        return marked.join(bad, md5, "left_anti").select(*docs.columns)
    at, searches = docs.columns.index(text), parts[0]

    def run(batches):
        tables = searches.value
        for batch in batches:
            clean = []
            for raw in as_bytes(batch.column(at)):
                words = split_words(raw)
                hit, _ = search(tables, words)
                clean.append(not contaminated(len(words), sum(e - s for s, e in hit)))
            yield batch.filter(pa.array(clean, pa.bool_()))

    return batchwise(docs, run, docs.schema)
