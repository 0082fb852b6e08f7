"""License scans, native: MinHash bands over overlapping text windows, then exact shingle containment.

Text and templates are lower-cased (A-Z) and cut into words of letters and ASCII digits; five words make a shingle. A
window is a run of shingles, one begins at each shingle. Each template is looked for by windows of one width: the largest
of WIDTHS that it has shingles for. It is indexed with all its full windows, by BANDS bands of one MinHash each (a window
of one shingle has but one), and every window of that width in a text is looked up. A text that holds the template, or a
window of it unchanged, holds a window of which all bands agree; an altered window meets with probability
1 - (1 - J) ** BANDS for its Jaccard similarity J, 0.992 where J is 0.8, and each window of the text is one more chance.

What is retrieved is verified: the share of the template's distinct shingles that the whole text contains, exactly, must
be LEAST or more. A copy of which that is so, with its order kept, has an unchanged window of eight shingles or of all it
has: a changed word costs five shingles, and where a fifth of them is lost some run between two changes is that long.

Templates with fewer than five words give no shingle and are refused. Band values of up to MOST_VALUES windows are part of
the expression, so that a row is decided where it lies, without a join or shuffle; rows that share no shingle with any
template have no MinHash computed. More are a stored table that the texts' windows are joined with.

Null, empty and shorter texts have no shingles and no licenses. Repeated rows give repeated results, extra columns pass.
Columns that begin with two underscores are used inside and may not be among them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import materialize
from quillspark.llm.license_texts import TEMPLATES

SHINGLE, WIDTHS, BANDS, LEAST, MOST_VALUES = 5, (1, 2, 4, 8), 3, 0.8, 20_000
#: A band's MinHash is the least of the hashes XOR its salt.
SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, -0x5BF7C6B2D1E0A943)


def _after(column: str, k: int) -> Column:
    """The array without its first k elements."""
    return F.slice(column, k + 1, F.greatest(F.size(column) - k, F.lit(0)))


def with_shingles(df: DataFrame, text: str, to: str) -> DataFrame:
    """df with the array of hashes of each run of SHINGLE words.

    Steps are columns of their own, each read twice by the next: arrays go into zip_with as arguments, and no lambda
    evaluates an array again for each element.
    """
    low = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df = df.withColumn("__1", F.transform(F.split(F.trim(F.regexp_replace(low, r"[^\p{L}0-9]+", " ")), " "), lambda w: F.xxhash64(w)))
    df = df.withColumn("__2", F.zip_with("__1", _after("__1", 1), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("__4", F.zip_with("__2", _after("__2", 2), lambda a, b: F.xxhash64(a, b)))
    five = F.zip_with("__4", _after("__1", 4), lambda a, b: F.xxhash64(a, b))  # its last four lack words
    return df.withColumn(to, F.slice(five, 1, F.greatest(F.size("__1") - (SHINGLE - 1), F.lit(0)))).drop("__1", "__2", "__4")


def with_minima(df: DataFrame, band: int, widths: list[int], when: Column) -> DataFrame:
    """df with columns `__m{band}_{width}`, empty where not `when`."""
    none = F.array().cast("array<bigint>")
    df = df.withColumn(f"__m{band}_1", F.when(when, F.transform("__s", lambda h: h.bitwiseXOR(F.lit(SALTS[band])))).otherwise(none))
    for w in WIDTHS[:-1]:
        if 2 * w <= max(widths):
            df = df.withColumn(f"__m{band}_{2 * w}", F.zip_with(f"__m{band}_{w}", _after(f"__m{band}_{w}", w), lambda a, b: F.least(a, b)))
    return df


def _literal(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values]).cast("array<bigint>")


def bands_of(width: int) -> int:
    return 1 if width == 1 else BANDS


def index(spark: SparkSession, templates: dict[str, str]) -> dict[str, dict]:
    """Each template's distinct shingles, its width, and its windows' values by band."""
    rows = with_shingles(spark.createDataFrame(sorted(templates.items()), "name string, t string"), "t", "__s").drop("t")
    for b in range(BANDS):
        rows = with_minima(rows, b, list(WIDTHS), F.lit(True))
    out = {}
    for r in rows.collect():
        n = len(r["__s"])
        if not n:
            raise ValueError(f"template {r['name']} has fewer than {SHINGLE} words")
        w = max(x for x in WIDTHS if x <= n)
        out[r["name"]] = {"shingles": sorted(set(r["__s"])), "width": w, "bands": [sorted(set(r[f"__m{b}_{w}"][: n - w + 1])) for b in range(bands_of(w))]}
    return out


def _kept(found: Column, least: float) -> tuple[Column, Column]:
    """Names of what was retrieved, and of what has enough containment."""
    return F.array_sort(F.transform(found, lambda c: c["name"])), F.array_sort(F.filter(found, lambda c: c["containment"] >= least))


def _scan_in_place(docs: DataFrame, found: dict[str, dict], text: str, least: float) -> DataFrame:
    s = F.col("__s")
    rows = with_shingles(docs, text, "__s")
    some = F.arrays_overlap(s, _literal(sorted({x for t in found.values() for x in t["shingles"]})))
    rows = rows.withColumn("__any", F.coalesce(some, F.lit(False)))
    widths = sorted({t["width"] for t in found.values()})
    for b in range(BANDS):
        rows = with_minima(rows, b, widths, F.col("__any"))
        for w in widths:
            if b < bands_of(w):
                every = _literal(sorted({x for t in found.values() if t["width"] == w for x in t["bands"][b]}))
                rows = rows.withColumn(f"__b{b}_{w}", F.array_intersect(f"__m{b}_{w}", every))
        rows = rows.drop(*[c for c in rows.columns if c.startswith(f"__m{b}_")])
    checks = []
    for name, t in sorted(found.items()):
        hits = [F.when(F.size(c := F.col(f"__b{b}_{t['width']}")) > 0, F.arrays_overlap(c, _literal(x))).otherwise(False) for b, x in enumerate(t["bands"])]
        share = F.when(reduce(lambda a, b: a | b, hits), F.size(F.array_intersect(s, _literal(t["shingles"]))) / len(t["shingles"]))
        checks.append(F.struct(F.lit(name).alias("name"), share.alias("containment")))
    got = F.array(*checks) if checks else F.array().cast("array<struct<name:string,containment:double>>")
    rows = rows.withColumn("__c", F.filter(got, lambda c: c["containment"].isNotNull()))
    retrieved, licenses = _kept(F.col("__c"), least)
    return rows.withColumn("retrieved", retrieved).withColumn("licenses", licenses).drop(*[c for c in rows.columns if c.startswith("__")])


def _scan_joined(docs: DataFrame, found: dict[str, dict], text: str, least: float) -> DataFrame:
    """The same by equi-joins: windows with a stored band table, candidates with the templates' shingles."""
    spark = docs.sparkSession
    values = materialize(spark.createDataFrame([(b, t["width"], x, n) for n, t in found.items() for b, v in enumerate(t["bands"]) for x in v], "band int, width int, value long, name string"))
    own = materialize(spark.createDataFrame([(n, t["shingles"]) for n, t in found.items()], "name string, __own array<bigint>"))
    widths = sorted({t["width"] for t in found.values()})
    rows = materialize(with_shingles(docs, text, "__s").withColumn("__row", F.monotonically_increasing_id()))
    parts = rows.select("__row", "__s")
    for b in range(BANDS):
        parts = with_minima(parts, b, widths, F.lit(True))

    def marked(b: int, w: int) -> Column:
        return F.transform(F.array_distinct(f"__m{b}_{w}"), lambda x: F.struct(F.lit(b).alias("band"), F.lit(w).alias("width"), x.alias("value")))

    windows = F.concat(*[marked(b, w) for w in widths for b in range(bands_of(w))])
    met = parts.select("__row", F.explode(windows).alias("w")).select("__row", "w.*").join(values, ["band", "width", "value"]).select("__row", "name").distinct()
    share = F.size(F.array_intersect("__s", "__own")) / F.size("__own")
    hits = met.join(own, "name").join(rows.select("__row", "__s"), "__row").groupBy("__row").agg(F.collect_list(F.struct("name", share.alias("containment"))).alias("__c"))
    none = F.array().cast("array<struct<name:string,containment:double>>")
    out = rows.drop("__s").join(hits, "__row", "left").withColumn("__c", F.coalesce("__c", none))
    retrieved, licenses = _kept(F.col("__c"), least)
    return out.withColumn("retrieved", retrieved).withColumn("licenses", licenses).drop("__row", "__c")


def scan(docs: DataFrame, templates: dict[str, str] | None = None, text: str = "text", least: float = LEAST) -> DataFrame:
    """docs with `licenses` (array of struct(name, containment) by name) and `retrieved` (templates the bands brought up)."""
    found = index(docs.sparkSession, TEMPLATES if templates is None else templates)
    few = sum(len(x) for t in found.values() for x in t["bands"]) <= MOST_VALUES
    return (_scan_in_place if few else _scan_joined)(docs, found, text, least)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, licenses (names, joined by ,), n_licenses, containment (the largest; 0 without any) of every document."""
    got = scan(docs.select("doc_id", "text"))
    return got.select(
        "doc_id",
        F.array_join(F.transform("licenses", lambda c: c["name"]), ",").alias("licenses"),
        F.size("licenses").cast("long").alias("n_licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda c: c["containment"])), F.lit(0.0)).alias("containment"),
    )
