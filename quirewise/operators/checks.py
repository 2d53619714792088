
from __future__ import annotations

import xml.etree.ElementTree as ET
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written
from .render import MIMETYPE, primary_writing_mode
from .structure import nav_order_problems

NCX_TYPE = "application/x-dtbncx+xml"


@F.pandas_udf(T.StringType())
def xml_error(data: pd.Series) -> pd.Series:
    """V2: what is wrong with an XML document, null if nothing."""

    def error(x) -> str | None:
        try:
            ET.fromstring(bytes(x) if not isinstance(x, str) else x)
        except ET.ParseError as e:
            return str(e)
        return None

    return data.map(error)


def problem(df: DataFrame, rule: str, detail: Column) -> DataFrame:
    return df.select("book_id", F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def zip_problems(entries: DataFrame) -> DataFrame:
    """V1: the type is the first entry, stored, and says what it should; entries: book_id, pos, name, stored, bytes."""
    first = entries.withColumn("_k", F.row_number().over(Window.partitionBy("book_id").orderBy("pos"))).where("_k = 1")
    named = F.col("name") == "mimetype"
    return problem(first.where(~named), "V1 first", F.col("name")).unionByName(problem(first.where(named & ~F.col("stored")), "V1 stored", F.col("name"))).unionByName(
        problem(first.where(named & (F.decode("bytes", "UTF-8") != MIMETYPE)), "V1 content", F.decode("bytes", "UTF-8"))
    )


def xml_problems(entries: DataFrame) -> DataFrame:
    """V2."""
    e = entries.where(F.col("name").rlike(r"\.(xhtml|opf|ncx)$")).withColumn("_e", xml_error("bytes")).where("_e is not null")
    return problem(e, "V2", F.concat_ws(": ", "name", "_e"))


def missing_files(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """V4: manifest: book_id, id, path (from the root of the package)."""
    m = manifest.join(entries.select("book_id", F.col("name").alias("path")), ["book_id", "path"], "left_anti")
    return problem(m, "V4", F.concat_ws(" ", "id", "path"))


def undeclared_files(manifest: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries other than the type, what is below META-INF/ and package documents."""
    e = entries.where("name <> 'mimetype' and name not like 'META-INF/%' and name not like '%.opf'").withColumnRenamed("name", "path")
    return problem(e.join(manifest.select("book_id", "path"), ["book_id", "path"], "left_anti"), "V12", F.col("path"))


def spine_problems(spine: DataFrame, manifest: DataFrame) -> DataFrame:
    """V5: idrefs that the manifest lacks."""
    s = spine.withColumnRenamed("idref", "id").join(manifest.select("book_id", "id"), ["book_id", "id"], "left_anti")
    return problem(s, "V5", F.col("id"))


def spine_order(spine: DataFrame, manifest: DataFrame) -> DataFrame:
    """V5: (book_id, href, pos), of a file's places the first."""
    s = spine.withColumnRenamed("idref", "id").join(manifest.select("book_id", "id", "href"), ["book_id", "id"])
    return s.groupBy("book_id", "href").agg(F.min("pos").alias("pos"))


def package_problems(packages: DataFrame, horizontal: bool = False) -> DataFrame:
    """V3, V7, V8, V10, V11 of packages(book_id, has_opf, has_spine, toc, ncx_ids, identifiers, uids, direction, modes)."""
    mode = primary_writing_mode(horizontal)
    whole = packages.where("has_opf and has_spine")
    ncx = F.size("ncx_ids") > 0
    right = F.array_contains("ncx_ids", F.col("toc"))
    rules = [
        problem(packages.where("not has_opf"), "V3 package", F.lit("missing")),
        problem(packages.where("has_opf and not has_spine"), "V3 spine", F.lit("missing")),
        problem(whole.where(ncx & ~F.coalesce(right, F.lit(False))), "V7 toc", F.coalesce("toc", F.lit("none"))),
        problem(whole.where(~ncx & F.col("toc").isNotNull()), "V7 ncx", F.col("toc")),
        problem(whole.where(ncx & F.coalesce(right, F.lit(False)) & (F.col("uids") != F.col("identifiers"))), "V8", F.array_join("uids", ",")),
        problem(whole.where(~F.col("direction").eqNullSafe(F.lit(None if horizontal else "rtl").cast("string"))), "V10", F.coalesce("direction", F.lit("none"))),
        problem(whole.where(F.col("modes") != F.array(F.lit(mode))), "V11", F.array_join("modes", ",")),
    ]
    return reduce(DataFrame.unionByName, rules)


def css_problems(sheets: DataFrame, horizontal: bool = False) -> DataFrame:
    """V9: writing modes of the rule for html and body; sheets: book_id, css (null if the file is missing)."""
    mode = "horizontal-tb" if horizontal else "vertical-rl"
    rule = F.regexp_extract("css", r"html,\s*body\s*\{([^}]*)\}", 0)
    modes = F.transform(F.regexp_extract_all(rule, F.lit(r"writing-mode:\s*([^;]+);"), 1), lambda m: F.btrim(m))
    s = sheets.withColumn("_r", rule).withColumn("_m", modes)
    why = (
        F.when(F.col("css").isNull(), "no style sheet").when(F.col("_r") == "", "no rule").when(F.size("_m") == 0, "no writing mode")
        .when(F.exists("_m", lambda m: m != mode), F.array_join("_m", ","))
    )
    return problem(s.withColumn("_w", why).where("_w is not null"), "V9", F.col("_w"))


PACKAGE = "book_id string, has_opf boolean, has_spine boolean, toc string, ncx_ids array<string>, identifiers array<string>, uids array<string>, direction string, modes array<string>, manifest array<struct<id:string,href:string,path:string,media_type:string,properties:string>>, spine array<struct<pos:int,idref:string>>, css string, nav array<struct<node_id:int,href:string>>"
# XML namespaces.
OPF, DC, NCX, XHTML, OPS = (
    "{http://www.idpf.org/2007/opf}", "{http://purl.org/dc/elements/1.1/}", "{http://www.daisy.org/z3986/2005/ncx/}", "{http://www.w3.org/1999/xhtml}", "{http://www.idpf.org/2007/ops}",
)


def read_packages(entries: DataFrame) -> DataFrame:
    """The parts of a package that rules look at, parsed a book at a time."""

    def read(group: pd.DataFrame) -> pd.DataFrame:
        import posixpath

        files = {n: bytes(b) for n, b in zip(group["name"], group["bytes"])}
        row: dict = {"book_id": group["book_id"].iloc[0], "has_opf": False, "has_spine": False, "toc": None, "ncx_ids": [], "identifiers": [], "uids": [], "direction": None, "modes": [], "manifest": [], "spine": [], "css": None, "nav": []}

        def tree(name):
            try:
                return ET.fromstring(files[name])
            except (KeyError, ET.ParseError):
                return None

        opf = next((n for n in files if n.endswith(".opf")), None)
        root = tree(opf) if opf else None
        if root is not None:
            row["has_opf"] = True
            full = lambda href: posixpath.join(posixpath.dirname(opf), href or "")
            items = list(root.find(f"{OPF}manifest") if root.find(f"{OPF}manifest") is not None else ())
            row["manifest"] = [{"id": i.get("id"), "href": i.get("href"), "path": full(i.get("href")), "media_type": i.get("media-type"), "properties": i.get("properties")} for i in items]
            row["ncx_ids"] = [i.get("id") for i in items if i.get("media-type") == NCX_TYPE]
            spine = root.find(f"{OPF}spine")
            if spine is not None:
                row |= {"has_spine": True, "toc": spine.get("toc"), "direction": spine.get("page-progression-direction"), "spine": [{"pos": k, "idref": r.get("idref")} for k, r in enumerate(spine)]}
            said = lambda found: [(e or "").strip() for e in found]
            row["identifiers"] = said(e.text for e in root.iterfind(f"{OPF}metadata/{DC}identifier") if e.get("id") == root.get("unique-identifier"))
            row["modes"] = said(m.get("content") for m in root.iterfind(f"{OPF}metadata/{OPF}meta") if m.get("name") == "primary-writing-mode")
            book = next((tree(full(i.get("href"))) for i in items if i.get("id") == row["toc"] and i.get("media-type") == NCX_TYPE), None)
            row["uids"] = said(m.get("content") for m in book.iterfind(f"{NCX}head/{NCX}meta") if m.get("name") == "dtb:uid") if book is not None else row["identifiers"]
            css = files.get(full("style.css"))
            row["css"] = css.decode() if css is not None else None
            for i in items:
                page = tree(full(i.get("href"))) if "nav" in (i.get("properties") or "").split() else None
                for nav in page.iter(f"{XHTML}nav") if page is not None else ():
                    if nav.get(f"{OPS}type") == "toc":
                        base = posixpath.dirname(i.get("href"))
                        links = [(a.get("href") or "") for a in nav.iter(f"{XHTML}a")]
                        row["nav"] = [{"node_id": k, "href": posixpath.normpath(posixpath.join(base, h))} for k, h in enumerate(links) if h.split("#")[0]]
                        break
        return pd.DataFrame([row])

    return entries.groupBy("book_id").applyInPandas(read, PACKAGE)


def self_check(entries: DataFrame, horizontal: bool = False) -> DataFrame:
    """(book_id, rule, detail) of what is wrong with packages; entries as from render.read_zips."""
    p = written(read_packages(entries), "package-parts")  # each rule reads it
    manifest = p.select("book_id", F.explode("manifest").alias("m")).select("book_id", "m.*")
    spine = p.select("book_id", F.explode("spine").alias("s")).select("book_id", "s.*")
    nav = p.select("book_id", F.explode("nav").alias("n")).select("book_id", "n.*")
    sheets = p.where("has_opf and has_spine").select("book_id", "css")
    order = nav_order_problems(nav, spine_order(spine, manifest))
    known = p.where("has_opf").select("book_id")
    rules = [
        zip_problems(entries), xml_problems(entries), package_problems(p, horizontal), missing_files(manifest, entries), spine_problems(spine, manifest), css_problems(sheets, horizontal),
        problem(order, "V6", F.concat_ws(" < ", "target", "before_target")), undeclared_files(manifest, entries.join(known, "book_id", "left_semi")),
    ]
    return reduce(DataFrame.unionByName, rules)
