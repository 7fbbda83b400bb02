"""Main text of web pages with wrappers inferred per host.

All pages of a host count.  Pages of equal block structure are summed where they
are read; the structures that are left are aligned one after the other into a regular
expression without unions: texts that differ become slots, items that some pages
lack become optional, neighbours that recur become repeated groups.  In a wrapper
the article's item is found once, by names, marks and the text that its slots
hold; every page of the host is then read along its wrapper.

Defined results
* null or empty html: empty text.
* a page without the wrapper's article part is read with a wrapper of its own.
* a null url, or one without a host, belongs to the host of the empty name.
* repeated rows get the same text; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import small_batches, stored
from lakegate.llm.page_tree import fold, infer, layout, main_text, parse, restored, slim
from lakegate.llm.url_filter import host_of

HELD_TEXTS = 100_000
"""Text slots that a task holds before it sends its partial sums on."""

BROADCAST_BYTES = 16 << 20


def page_layouts(pages: DataFrame) -> DataFrame:
    """``host, layout, structure, texts`` from ``host, html``: partial sums of each task over equal layouts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        slots = 0

        def flush() -> pa.RecordBatch:
            found = [[{"text": t, "chars": c, "links": k} for t, c, k in texts] for _, texts in held.values()]
            return pa.RecordBatch.from_arrays([
                pa.array([host for host, _ in held], pa.string()), pa.array([key for _, key in held], pa.binary()),
                pa.array([structure for structure, _ in held.values()], pa.string()), pa.array(found, texts_type)],
                names=["host", "layout", "structure", "texts"])

        texts_type = pa.list_(pa.struct([("text", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())]))
        for batch in batches:
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html")):
                structure, texts = layout(fold(parse(page.as_py())))
                key = (host, xxhash.xxh3_128_digest(structure.encode("utf-8", "surrogatepass")))
                if key in held:
                    held[key][1] = [(a[0] if a[0] == b[0] else None, a[1] + b[1], a[2] + b[2])
                                    for a, b in zip(held[key][1], texts)]
                else:
                    held[key] = [structure, texts]
                    slots += len(texts) + 1
            if slots > HELD_TEXTS:
                yield flush()
                held.clear()
                slots = 0
        if held:
            yield flush()

    return pages.where("html <> ''").select("host", "html").mapInArrow(
        run, "host string, layout binary, structure string, texts array<struct<text: long, chars: long, links: long>>")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper`` (JSON) of ``host, html``, from all pages.

    Texts of equal layouts are summed by partial aggregations, so a host of any
    share of the pages stays spread; one row per layout meets the host's others,
    in the order of the layouts' hashes, whatever the splits were.
    """
    parts = stored(page_layouts(pages))
    structures = parts.groupBy("layout").agg(F.min("structure").alias("structure"))
    same = (F.min("t.text") == F.max("t.text")) & (F.count("t.text") == F.count(F.lit(1)))
    summed = (parts.select("host", "layout", F.posexplode_outer("texts").alias("at", "t"))
              .groupBy("host", "layout", "at")
              .agg(F.when(same, F.min("t.text")).alias("text"), F.sum("t.chars").alias("chars"), F.sum("t.links").alias("links")))
    texts = summed.groupBy("host", "layout").agg(F.sort_array(F.collect_list(F.when(
        F.col("at").isNotNull(), F.struct("at", "text", "chars", "links")))).alias("texts"))
    distinct = (pages.where("html <> ''").select("host", F.xxhash64("html").alias("h")).distinct()
                .groupBy("host").agg(F.count(F.lit(1)).alias("pages")))
    layouts = texts.join(structures, "layout").join(distinct, "host")

    def one(host: pa.Table) -> pa.Table:
        rows = sorted(host.to_pylist(), key=lambda r: r["layout"])
        wrappers = [restored(r["structure"], [(t["text"], t["chars"], t["links"]) for t in r["texts"]]) for r in rows]
        wrapper = json.dumps(slim(infer(wrappers, rows[0]["pages"])), separators=(",", ":"))
        return pa.table({"host": pa.array([rows[0]["host"]], pa.string()), "wrapper": pa.array([wrapper], pa.string())})

    return layouts.groupBy("host").applyInArrow(one, "host string, wrapper string")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` per row of a stored table ``page_id, url, html``."""
    small_batches(pages.sparkSession)
    base = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    wrappers = stored(infer_wrappers(base.select("host", "html")))
    size = wrappers.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0)).alias("b")).first()["b"]
    small = F.broadcast(wrappers) if size <= BROADCAST_BYTES else wrappers
    joined = base.select("page_id", "url", "html", "host").join(small, "host", "left").select("page_id", "url", "html", "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, wrapper = None, None
        for batch in batches:
            texts = []
            for page, code in zip(batch.column("html"), batch.column("wrapper")):
                code = code.as_py()
                if code != held:
                    held, wrapper = code, json.loads(code) if code else None
                texts.append(main_text(page.as_py(), wrapper))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    id_type = pages.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string")
