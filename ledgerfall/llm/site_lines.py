"""Lines that a large share of a site's pages carry are boilerplate and are dropped.

DataFrame functions only.  A site is a value of the host column, null included.

Steps: each page's different lines, counted by (site, line); the counts that
exceed the ratio of the site's pages; which of them each different page text has;
the texts without them.  Lines are compared trimmed and travel as 16-byte digests.
A site or a line with a third of all pages is pre-aggregated where it is read, and
every join has one row per key on one side, so that skewed partitions can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line on more than this share of a site's pages, and on this many of them at least, is boilerplate.
RATIO = 0.08
MIN_PAGES = 5

BLANK = " \t\r\f\x0b"
SITE, TEXT, LINE, LINES = "__site", "__text", "__line", "__boilerplate"


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def _key(line: Column) -> Column:
    return _digest(F.btrim(line, F.lit(BLANK)))


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANK)) != ""


def _pages(docs: DataFrame, host: str) -> DataFrame:
    """Every row's site, text digest and different non-blank lines."""
    lines = F.array_distinct(F.transform(F.filter(_split(F.col("text")), _filled), _key))
    return docs.select(_site(host), _digest(F.col("text")).alias(TEXT), lines.alias("lines"))


def _site(host: str) -> Column:
    return _digest(F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))).alias(SITE)


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Digests of each site's boilerplate lines: ``__site, __line``.

    A line twice on a page counts once, a row of ``docs`` is a page, and blank
    lines never count.
    """
    counts = (
        _pages(docs, host)
        .select(SITE, F.explode("lines").alias(LINE))
        .groupBy(SITE, LINE)
        .agg(F.count(F.lit(1)).alias("having"))
        .where(F.col("having") >= min_pages)
    )
    totals = docs.select(_site(host)).groupBy(SITE).agg(F.count(F.lit(1)).alias("pages"))
    return counts.join(totals, SITE).where(F.col("having") > ratio * F.col("pages")).select(SITE, LINE)


def without_boilerplate(
    docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES
) -> DataFrame:
    """All rows of ``docs``, ``text`` without its boilerplate lines, and ``n_lines``, ``n_dropped``.

    - A null text stays null, with 0 lines; an empty text is one blank line.
    - Blank lines stay, at the place they have.
    - A text of which no other line would be left keeps all its lines: a page that
      recurs whole is a copy, not boilerplate.
    - Repeated rows are pages of their own and all stay; very long texts are gone
      through whole; an empty table gives no rows.  Other columns are not read;
      ``n_lines`` and ``n_dropped`` of the input are replaced.
    """
    lines = boilerplate(docs, host, ratio, min_pages)
    found = (
        _pages(docs, host)
        .select(SITE, TEXT, F.explode("lines").alias(LINE))
        .join(lines, [SITE, LINE])
        .groupBy(SITE, TEXT)
        .agg(F.collect_set(LINE).alias(LINES))
    )
    # A site has at most (lines per page / ratio) boilerplate lines, so the list is short.
    dropped = lambda line: F.array_contains(F.col(LINES), _key(line))
    texts = docs.withColumns({SITE: _site(host), TEXT: _digest(F.col("text"))}).join(found, [SITE, TEXT], "left")
    all_lines = _split(F.col("text"))
    kept = F.filter(all_lines, lambda line: ~dropped(line))
    some = F.col(LINES).isNotNull() & F.exists(kept, _filled)
    result = texts.withColumns(
        {
            "n_lines": F.coalesce(F.size(all_lines), F.lit(0)),
            "n_dropped": F.when(some, F.size(all_lines) - F.size(kept)).otherwise(0),
            "text": F.when(some, F.array_join(kept, "\n")).otherwise(F.col("text")),
        }
    )
    return result.select(*docs.drop("n_lines", "n_dropped").columns, "n_lines", "n_dropped")


ORACLE = f"""
WITH lines AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                      unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS k FROM lines),
counts AS (SELECT source, k, count(DISTINCT doc_id) AS having_it FROM keyed WHERE k <> '' GROUP BY source, k),
totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source),
bad AS (SELECT c.source, c.k FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
        WHERE having_it >= {MIN_PAGES} AND having_it > {RATIO} * pages),
marked AS (SELECT l.*, b.k IS NOT NULL AS gone FROM keyed l LEFT JOIN bad b ON l.source IS NOT DISTINCT FROM b.source AND l.k = b.k),
pages AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS gone, bool_or(NOT gone AND k <> '') AS any_left,
                 string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN gone > 0 AND any_left THEN kept ELSE d.text END AS text,
       coalesce(n_lines, 0) AS n_lines, CASE WHEN any_left THEN coalesce(gone, 0) ELSE 0 END AS n_dropped
FROM documents d LEFT JOIN pages USING (doc_id)
"""
