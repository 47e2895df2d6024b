"""Aligning pages to a reference edition, and marked text by box overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S

# Least share of a word's area under a mark; coverage below which a master is suspect.
WORD_SHARE, LEAST_COVERAGE = 0.20, 0.80


def master_index(pages: DataFrame, text: str, page: str, book_page: str) -> DataFrame:
    """(fingerprint, book_page, master_pdf_page): of pages with one text the
    last page counts; at a tie the larger book page."""
    return (
        pages.where(S.strip(F.col(text)) != "")
        .groupBy(S.fingerprint(S.collapse(F.col(text))).alias("fingerprint"))
        .agg(F.max(F.struct(F.col(page).alias("p"), S.text(F.col(book_page)).alias("b"))).alias("m"))
        .select("fingerprint", F.col("m.b").alias("book_page"), F.col("m.p").alias("master_pdf_page"))
    )


def map_pages(pages: DataFrame, master: DataFrame, text: str, label: str, candidates: str | None = None) -> DataFrame:
    """Add mapped_page, mapping_method, mapping_confidence: by the master's
    text, else by the page's own label, else by the first footer candidate."""
    m = master.select(F.col("fingerprint").alias("_fp"), F.col("book_page").alias("_bp"))
    rows = pages.withColumn("_f", S.fingerprint(S.collapse(F.col(text)))).join(m, F.col("_f") == F.col("_fp"), "left")
    by_text, by_label = S.blank_null(F.col("_bp")), S.blank_null(F.col(label))
    found = F.filter(F.col(candidates), lambda c: S.strip(c) != "") if candidates else F.array().cast("array<string>")
    by_footer = F.try_element_at(found, F.lit(1))
    status = S.footer_status(F.coalesce(by_text, by_label), found)
    base = F.when(by_text.isNotNull(), "master_text_fingerprint").otherwise("pdf_page_label")
    known = F.coalesce(by_text, by_label).isNotNull()
    return rows.withColumns(
        {
            "mapped_page": F.coalesce(by_text, by_label, by_footer, F.lit("")),
            "mapping_method": F.when(known, F.when(status == "", base).otherwise(F.concat(base, F.lit("+"), status))).when(by_footer.isNotNull(), "footer_only_unverified").otherwise("unresolved"),
            "mapping_confidence": F.when(known, F.when(status == "footer_mismatch", 0.6).otherwise(1.0)).when(by_footer.isNotNull(), 0.25).otherwise(0.0),
        }
    ).drop("_f", "_fp", "_bp")


def mapping_coverage(pages: DataFrame, by: str, mapped: str, master_pages: int | None = None) -> DataFrame:
    """Per group: pages, mapped pages, coverage to four decimals (0 without
    pages), whether the master is suspect, and pages beyond the master."""
    n, hit = F.count("*"), F.count_if(S.strip(F.col(mapped)) != "")
    coverage = F.when(n > 0, F.bround(hit / n, 4)).otherwise(0.0)
    return pages.groupBy(by).agg(
        n.alias("pages"), hit.alias("mapped_pages"), (n - hit).alias("unresolved_pages"), coverage.alias("coverage"), ((n > 0) & (coverage < LEAST_COVERAGE)).alias("master_suspect"),
        F.greatest(n - F.lit(master_pages if master_pages is not None else 2**31), F.lit(0)).alias("pages_beyond_master"),
    )


def box_overlaps(a: DataFrame, b: DataFrame, scope: list[str], box: tuple[str, str, str, str], id_a: str, id_b: str, share: float = WORD_SHARE, cell: float = 64.0) -> DataFrame:
    """(scope, id_a, id_b, ratio): boxes of ``a`` that cover at least ``share``
    of a box of ``b`` in the same scope.

    Both sides go to the cells of a grid they touch and meet by (scope, cell),
    so neither a page nor a document makes all pairs; a pair counts in the cell
    of the upper left corner of the common part only.
    """
    def cells(df: DataFrame, name: str, p: str) -> DataFrame:
        x0, y0, x1, y1 = (F.col(c) for c in box)
        ok = df.where((x1 > x0) & (y1 > y0))
        span = lambda lo, hi: F.sequence(F.floor(lo / cell), F.floor(hi / cell))
        gx = ok.select(*scope, F.col(name).alias(f"{p}id"), *[c.alias(f"{p}{i}") for i, c in enumerate((x0, y0, x1, y1))], F.explode(span(x0, x1)).alias("cx"), span(y0, y1).alias("ys"))
        return gx.select("*", F.explode("ys").alias("cy")).drop("ys")

    j = cells(a, id_a, "a").join(cells(b, id_b, "b"), [*scope, "cx", "cy"])
    corner = (F.floor(F.greatest("a0", "b0") / cell) == F.col("cx")) & (F.floor(F.greatest("a1", "b1") / cell) == F.col("cy"))
    area = S.overlap_area([F.col(f"a{i}") for i in range(4)], [F.col(f"b{i}") for i in range(4)])
    ratio = area / ((F.col("b2") - F.col("b0")) * (F.col("b3") - F.col("b1")))
    return j.where(corner).select(*scope, F.col("aid").alias("id_a"), F.col("bid").alias("id_b"), ratio.alias("ratio")).where(F.col("ratio") >= share)


def marked_text(marks: DataFrame, words: DataFrame, scope: list[str], box: tuple[str, str, str, str], mark: str, quad: str, word_no: str, text: str) -> DataFrame:
    """(scope, mark, marked_text): the words under a mark's boxes, in the order
    of boxes and words."""
    m = marks.withColumn("_m", F.struct(F.col(mark).alias("mark"), F.col(quad).alias("quad")))
    w = words.withColumn("_w", F.struct(F.col(word_no).alias("no"), F.col(text).alias("text")))
    hit = box_overlaps(m, w, scope, box, "_m", "_w")
    ordered = F.array_sort(F.collect_list(F.struct("id_a.quad", "id_b.no", "id_b.text")))
    return hit.groupBy(*scope, F.col("id_a.mark").alias(mark)).agg(F.array_join(F.transform(ordered, lambda x: x["text"]), " ").alias("marked_text"))
