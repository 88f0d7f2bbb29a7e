"""URL resolution (T-URL, T-DEFRAG, T-NORM) as Spark column expressions.

Contract (our reading of the reference's join of a reference against the page URL):

* tabs/newlines are removed from the reference, leading control characters
  and spaces stripped;
* an absolute ``http://`` / ``https://`` reference (any case) replaces the
  base and then resolves like an empty reference;
* the base loses its fragment, its scheme is lower-cased and an empty query
  marker is dropped;
* another scheme (``mailto:``, ``javascript:`` ...) is returned unchanged;
* ``//host/...`` takes the base scheme; ``?q`` / ``#f`` keep the base path;
* relative paths merge with the base directory, empty middle segments are
  dropped and dot segments removed (``..`` never climbs above the root);
* a relative reference keeps its own fragment.

No built-in URL join exists in Spark; everything below is regex extraction
and higher-order array functions, evaluated in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEME_RE = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"


def defrag(url: Column) -> Column:
    return F.regexp_replace(url, r"#.*$", "")


def normalize_base(url: Column) -> Column:
    """Drop the fragment, lower-case the scheme, drop an empty trailing query marker."""
    u = defrag(url)
    scheme = F.regexp_extract(u, SCHEME_RE, 1)
    lowered = F.when(
        scheme != "", F.concat(F.lower(scheme), F.lit(":"), F.regexp_replace(u, SCHEME_RE, ""))
    ).otherwise(u)
    return F.regexp_replace(lowered, r"\?$", "")


def _clean_ref(ref: Column) -> Column:
    no_ws = F.regexp_replace(F.coalesce(ref, F.lit("")), r"[\t\r\n]", "")
    return F.regexp_replace(no_ws, r"^[\x00-\x20]+", "")


def _remove_dots(segments: Column) -> Column:
    """Python's dot-segment loop: '..' pops (never below empty), '.' is skipped."""
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        ).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    last = F.element_at(segments, -1)
    return F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)


def _merge_path(base_path: Column, ref_path: Column) -> Column:
    base_parts = F.split(base_path, "/", -1)
    dir_parts = F.when(F.element_at(base_parts, -1) != "", F.slice(base_parts, 1, F.size(base_parts) - 1)).otherwise(
        base_parts
    )
    segs = F.concat(dir_parts, F.split(ref_path, "/", -1))
    n = F.size(segs)
    # Empty segments strictly between the first and the last are dropped.
    middle = F.filter(F.slice(segs, 2, F.greatest(n - 2, F.lit(0))), lambda x: x != "")
    compact = F.when(n >= 2, F.concat(F.slice(segs, 1, 1), middle, F.slice(segs, n, 1))).otherwise(segs)
    absolute = F.split(ref_path, "/", -1)
    resolved = F.when(F.substring(ref_path, 1, 1) == "/", _remove_dots(absolute)).otherwise(_remove_dots(compact))
    path = F.array_join(resolved, "/")
    return F.when(path == "", F.lit("/")).otherwise(path)


def with_resolved_url(df: DataFrame, base_col: str, ref_col: str, out: str) -> DataFrame:
    """Add ``out`` = ``ref_col`` joined against ``base_col`` (an href, possibly empty or null).

    Computed in stages (each intermediate column once) instead of one nested
    expression, so the parts of the base and the reference are parsed once per row.
    """
    tmp = [f"_u{i}" for i in range(14)]
    r0, abs_, b, bs, bn, bp, bq, rs, rr, rp, rq, rf, nn, np_ = tmp
    s1 = df.withColumn(r0, _clean_ref(F.col(ref_col)))
    s1 = s1.withColumn(abs_, F.lower(F.col(r0)).startswith("http://") | F.lower(F.col(r0)).startswith("https://"))
    s2 = s1.withColumn(b, normalize_base(F.when(F.col(abs_), F.col(r0)).otherwise(F.col(base_col)))).withColumn(
        r0, F.when(F.col(abs_), F.lit("")).otherwise(F.col(r0))
    )
    s3 = s2.withColumns({
        bs: F.lower(F.regexp_extract(F.col(b), SCHEME_RE, 1)),
        bn: F.regexp_extract(F.col(b), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://([^/?#]*)", 1),
        bp: F.regexp_extract(F.col(b), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)", 1),
        bq: F.regexp_extract(F.col(b), r"^[^?#]*\?([^#]*)", 1),
        rs: F.lower(F.regexp_extract(F.col(r0), SCHEME_RE, 1)),
    })
    same_scheme = (F.col(rs) != "") & (F.col(rs) == F.col(bs))
    s4 = s3.withColumn(rr, F.when(same_scheme, F.regexp_replace(F.col(r0), SCHEME_RE, "")).otherwise(F.col(r0)))
    s5 = s4.withColumns({
        rp: F.regexp_extract(F.col(rr), r"^([^?#]*)", 1),
        rq: F.regexp_extract(F.col(rr), r"^[^?#]*\?([^#]*)", 1),
        rf: F.regexp_extract(F.col(rr), r"^[^#]*#(.*)$", 1),
        nn: F.regexp_extract(F.col(rr), r"^//([^/?#]*)", 1),
        np_: F.regexp_extract(F.col(rr), r"^//[^/?#]*([^?#]*)", 1),
    })

    def assemble(netloc: Column, path: Column, query: Column, frag: Column) -> Column:
        p = F.when((path != "") & (F.substring(path, 1, 1) != "/"), F.concat(F.lit("/"), path)).otherwise(path)
        return F.concat(
            F.col(bs), F.lit("://"), netloc, p,
            F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
            F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")),
        )

    resolved = (
        F.when(F.col(r0) == "", F.col(b))
        .when((F.col(rs) != "") & ~same_scheme, F.col(r0))
        .when(F.col(rr).startswith("//"), assemble(F.col(nn), F.col(np_), F.col(rq), F.col(rf)))
        .when(F.col(rp) == "", assemble(F.col(bn), F.col(bp),
                                         F.when(F.col(rq) != "", F.col(rq)).otherwise(F.col(bq)), F.col(rf)))
        .otherwise(assemble(F.col(bn), _merge_path(F.col(bp), F.col(rp)), F.col(rq), F.col(rf)))
    )
    return s5.withColumn(out, resolved).drop(*tmp)
