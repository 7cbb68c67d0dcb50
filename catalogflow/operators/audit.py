"""Catalog checks and image reference checks as tables of findings."""

from pyspark.sql import functions as F

from ..functions.nulls import col, is_missing, matches
from ..functions.text import image_sources, resolve_asset_path
from .dedupe import digest

# fixed values: file signatures (hex) and what each extension promises
SIGNATURES = [
    ("PNG", r"^89504E470D0A1A0A"),
    ("JPEG", r"^FFD8FF"),
    ("GIF", r"^474946383[79]61"),
    ("WEBP", r"^52494646.{8}57454250"),
    ("TIFF", r"^(49492A00|4D4D002A)"),
]
EXTENSIONS = {"png": "PNG", "jpg": "JPEG", "jpeg": "JPEG", "gif": "GIF", "webp": "WEBP"}
BROWSER_FORMATS = ("PNG", "JPEG", "GIF", "WEBP")


def detected_format(content):
    head = F.hex(F.substring(col(content), 1, 12))
    out = F.lit(None).cast("string")
    for name, pattern in reversed(SIGNATURES):
        out = F.when(head.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def sniff_format(df, path="path", content="content"):
    """Add format, the extension's promise, and the reason of a mismatch."""
    suffix = F.lower(F.regexp_extract(col(path), r"\.([^./]+)$", 1))
    expected = F.lit(None).cast("string")
    for ext, name in EXTENSIONS.items():
        expected = F.when(suffix == ext, F.lit(name)).otherwise(expected)
    actual = F.col("format")
    reason = (
        F.when(actual.isNull(), F.lit("cannot decode image"))
        .when(
            F.col("expected").isNotNull() & (F.col("expected") != actual),
            F.concat(F.lit("extension ."), suffix, F.lit(" but actual format is "), actual),
        )
        .when(~actual.isin(*BROWSER_FORMATS), F.concat(F.lit("unsupported browser image format: "), actual))
    )
    checked = df.withColumn("format", detected_format(content)).withColumn("expected", expected)
    return checked.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def page_references(pages, url, html, base_dir="", known_prefixes=(), tag="img", attribute="src"):
    """Local references of each page, one row each; external ones are left out."""
    # outer, so that the planner adds no filter that scans the page again
    refs = pages.select(url, F.explode_outer(image_sources(html, tag, attribute)).alias("src")).filter("src is not null")
    return refs.withColumn("path", resolve_asset_path("src", base_dir, known_prefixes)).filter("path is not null")


def image_failures(references, inventory):
    """References without a file, or to a file in a wrong format.

    ``inventory`` is the result of ``sniff_format``: one row per path.
    """
    files = inventory.select(F.col("path").alias("_p"), F.col("reason").alias("_r"), F.lit(True).alias("_hit"))
    joined = references.join(files, F.col("path") == F.col("_p"), "left")
    reason = F.when(F.col("_hit").isNull(), F.concat(F.lit("missing file for "), F.col("src"))).otherwise(F.col("_r"))
    return joined.withColumn("reason", reason).drop("_p", "_r", "_hit").filter("reason is not null")


def image_summary(references, failures, url):
    """Checked and failed references per page."""
    both = references.select(url, F.lit(0).alias("_bad")).unionAll(failures.select(url, F.lit(1).alias("_bad")))
    return both.groupBy(url).agg(
        F.count_if(F.col("_bad") == 0).alias("checked"), F.count_if(F.col("_bad") == 1).alias("failures")
    )


def raise_on_failures(failures):
    """Make reading the result fail when there is any failure row."""
    message = F.concat(F.lit("image check failed: "), F.col("reason"))
    return failures.withColumn("reason", F.raise_error(message).cast("string"))


def catalog_checks(df, title="Title", authors="Authors", pages="Pages", url="URL", date="IssueDate"):
    """Rule and number of violating rows, one row per rule."""
    by = digest(df, [title, url])  # digests travel, texts do not
    rules = {
        "authors_without_digits": F.count_if(matches(authors, r"\d")),
        "pages_prefix": F.count_if(~F.coalesce(F.startswith(col(pages), F.lit("pp. ")), F.lit(False))),
        "known_date": F.count_if(col(date).isNull()),
        "has_title": F.count_if(is_missing(title)),
        "no_duplicates": F.count(F.lit(1)) - F.count_distinct(F.struct(title, url) if by is None else by),
    }
    totals = df.agg(*[value.alias(name) for name, value in rules.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return totals.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def missing_warnings(df, issue_key, doi, access, image):
    """Rows without DOI, access status or image, per issue."""
    def blank(c):
        return is_missing(c) | (col(c) == "")

    return df.groupBy(issue_key).agg(
        F.count_if(blank(doi)).alias("no_doi"),
        F.count_if(blank(access)).alias("no_access"),
        F.count_if(blank(image)).alias("no_image"),
    )
