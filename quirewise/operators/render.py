
from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

# Tags, marks and documents of the output formats.
TAGS = {"大": "h1", "中": "h2", "小": "h3"}
UNTITLED = "本文"
XHTML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE html>\n<html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops" xml:lang="{lang}" lang="{lang}">\n<head><meta charset="UTF-8"/><title>'
CONTAINER = '<?xml version="1.0" encoding="UTF-8"?>\n<container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container">\n   <rootfiles>\n      <rootfile full-path="OEBPS/package.opf" media-type="application/oebps-package+xml"/>\n   </rootfiles>\n</container>\n'
MIMETYPE = "application/epub+zip"
PAGE_BREAK, BOX_START, BOX_END = "［＃改ページ］", "［＃ここから罫囲み］", "［＃ここで罫囲み終わり］"


def lit(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def heading_parts(lines: Column) -> Column:
    return X.let(F.filter(X.normalize_lines(lines), lambda p: p != ""), X.subtitle_dash)


def heading(lines: Column, level: Column, id_: Column, vertical: bool = True) -> Column:
    """R1."""
    tag = F.element_at(F.create_map(*(F.lit(x) for kv in TAGS.items() for x in kv)), level)

    def render(parts: Column) -> Column:
        first = lit("<", tag, F.when(id_.isNull(), "").otherwise(lit(' id="', id_, '"')), ">", X.render_inline(parts[0], vertical), "</", tag, ">")
        rest = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: lit('<p class="subtitle">', X.render_inline(p, vertical), "</p>"))
        return F.when(F.size(parts) == 0, "").otherwise(F.array_join(F.concat(F.array(first), rest), "\n"))

    return X.let(heading_parts(lines), render)


def cell_texts(tables: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of tables, a row each, and their text as one normalized line; of cells at one place the last."""
    c = tables.select(*keys, F.posexplode("cells").alias("_i", "c"))
    text = X.join_lines(F.split(F.coalesce("c.contents", F.lit("")), "\n", -1))
    c = c.select(*keys, "_i", "c.row", "c.col", X.normalize(text).alias("cell_text"))
    last = F.row_number().over(Window.partitionBy(*keys, "row", "col").orderBy(F.desc("_i")))
    return c.withColumn("_k", last).where("_k = 1").drop("_k")


def table_html(cells: Column, n_row: Column, n_col: Column) -> Column:
    """R2: a table's grid, built within its row. Of cells at one place the last counts; places under a span are left out."""
    span = lambda n: F.greatest(F.coalesce(n, F.lit(1)), F.lit(1))
    texts = X.normalize_lines(F.transform(cells, lambda c: X.join_lines(F.split(F.coalesce(c["contents"], F.lit("")), "\n", -1))))
    full = F.transform(F.arrays_zip(cells.alias("c"), texts.alias("t")), lambda x: F.struct(x["c"]["row"].alias("row"), x["c"]["col"].alias("col"), span(x["c"]["row_span"]).alias("rs"), span(x["c"]["col_span"]).alias("cs"), x["t"].alias("t")))
    ones = lambda n: F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    told = lambda name, n: F.when(n > 1, lit(f' {name}="', n.cast("string"), '"')).otherwise("")
    td = lambda c: lit("<td", told("rowspan", c["rs"]), told("colspan", c["cs"]), ">", X.render_inline(c["t"], False), "</td>")

    def grid(every: Column) -> Column:
        wide = F.filter(every, lambda c: (c["rs"] > 1) | (c["cs"] > 1))

        def line(r: Column) -> Column:
            mine, over = F.filter(every, lambda c: c["row"] == r), F.filter(wide, lambda c: r.between(c["row"], c["row"] + c["rs"] - 1))
            under = lambda k: F.exists(over, lambda c: k.between(c["col"], c["col"] + c["cs"] - 1) & ((r != c["row"]) | (k != c["col"])))
            shown = F.filter(ones(n_col), lambda k: ~under(k))
            one = lambda k: F.coalesce(F.get(F.reverse(F.transform(F.filter(mine, lambda c: c["col"] == k), td)), F.lit(0)), F.lit("<td></td>"))
            return lit("<tr>", F.array_join(F.transform(shown, one), ""), "</tr>")

        return F.array_join(F.transform(ones(n_row), line), "\n")

    return lit('<table class="h-table">\n', X.let(full, grid), "\n</table>")


def tables_html(tables: DataFrame, keys: list[str]) -> DataFrame:
    """R2: (keys, html) of tables(keys, n_row, n_col, cells), without a shuffle."""
    cells = F.coalesce(F.col("cells"), F.array().cast(tables.schema["cells"].dataType))
    return tables.select(*keys, F.coalesce("n_row", F.lit(0)).alias("n_row"), F.coalesce("n_col", F.lit(0)).alias("n_col"), cells.alias("cells")).select(*keys, table_html(F.col("cells"), F.col("n_row"), F.col("n_col")).alias("html"))


def figure(src: Column, alt: Column) -> Column:
    """R3."""
    return lit('<figure class="h-figure"><img src="../images/', src, '" alt="', X.escape_attr(X.strip_ruby(F.coalesce(alt, F.lit("")))), '"/></figure>')


def blocks_html(blocks: DataFrame, vertical: bool = True) -> DataFrame:
    """Blocks with html; an unknown kind fails."""
    keys = ["book_id", "seq"]
    tables = tables_html(blocks.where("kind = 'table'"), keys).withColumnRenamed("html", "_table")
    b = blocks.join(tables, keys, "left")
    paragraph = lambda t: F.when(F.coalesce(t, F.lit("")) == "", "").otherwise(lit("<p>", X.render_inline(t, vertical), "</p>"))
    id_ = F.col("id") if "id" in blocks.columns else F.lit(None).cast("string")
    kind = F.col("kind")
    html = (
        F.when(kind == "para", X.let(X.normalize(X.join_lines(F.col("lines"))), paragraph))
        .when(kind == "raw", paragraph(F.col("text")))
        .when(kind == "heading", heading(F.col("lines"), F.col("level"), id_, vertical))
        .when(kind == "table", F.col("_table"))
        .when(kind == "figure", figure(F.col("src"), F.col("alt")))
        .otherwise(F.raise_error(lit("unknown kind of block: ", F.coalesce(kind, F.lit("null")))))
    )
    return b.withColumn("html", html).drop("_table")


def xhtml_page(title: Column, body: Column, css: str, section_type: Column, lang: str = "ja") -> Column:
    """A document."""
    return lit(
        XHTML_HEAD.format(lang=lang), X.escape(title), f'</title>\n<link rel="stylesheet" type="text/css" href="{css}"/></head>\n<body><section epub:type="', section_type, '">\n',
        body, "\n</section></body>\n</html>\n",
    )


def chapters_xhtml(blocks: DataFrame, vertical: bool = True) -> DataFrame:
    """(book_id, chapter_no, file, xhtml) of blocks with chapter_no, file and section_type."""
    b = blocks_html(blocks, vertical)
    b = b.withColumn("_title", F.when(F.col("kind") == "heading", X.strip_ruby(X.heading_title(F.col("lines")))))
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("html") != "", F.struct("seq", "html")))), lambda s: s["html"]), "\n")
    c = b.groupBy("book_id", "chapter_no", "file", "section_type").agg(html.alias("body"), F.min_by("_title", "seq").alias("title"))
    title = F.when(F.coalesce("title", F.lit("")) == "", UNTITLED).otherwise(F.col("title"))
    return c.select("book_id", "chapter_no", "file", xhtml_page(title, F.col("body"), "../style.css", F.col("section_type")).alias("xhtml"))


def nested(nav: DataFrame, item, wrap, depth: int = 3) -> DataFrame:
    """(book_id, html) of a tree given as rows, built from the leaves up; item(children) renders a node."""
    rows = nav.withColumn("_kids", F.lit(""))
    level = rows
    for d in range(depth, 1, -1):
        leaf = level.where(F.col("depth") == d).withColumn("_html", item(F.col("_kids")))
        kids = leaf.groupBy("book_id", F.col("parent_id").alias("node_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "_html"))), lambda s: s["_html"]), "").alias("_inner"))
        level = level.where(F.col("depth") < d).join(kids, ["book_id", "node_id"], "left").withColumn("_kids", F.coalesce(wrap(F.col("_inner")), F.col("_kids"))).drop("_inner")
    top = level.withColumn("_html", item(F.col("_kids")))
    return top.groupBy("book_id").agg(wrap(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node_id", "_html"))), lambda s: s["_html"]), "")).alias("html"))


def nav_lists(nav: DataFrame, vertical: bool = True) -> DataFrame:
    """The nested list of each book."""
    link = lit('<a href="', X.escape_attr(F.col("href")), '">', X.render_inline(F.col("title"), vertical), "</a>")
    return nested(nav, lambda kids: lit("<li>", link, kids, "</li>"), lambda inner: lit("<ol>", inner, "</ol>"))


def nav_xhtml(nav: DataFrame, books: DataFrame, vertical: bool = True) -> DataFrame:
    """(book_id, xhtml); books: book_id, first_href (null if a book has no chapter)."""
    j = books.join(nav_lists(nav, vertical), "book_id", "left")
    first = X.escape_attr(F.col("first_href"))
    fallback = lit('<ol><li><a href="', F.coalesce(first, F.lit("nav.xhtml")), f'">{UNTITLED}</a></li></ol>')
    marks = lit('<li><a epub:type="cover" href="cover.xhtml">表紙</a></li><li><a epub:type="toc" href="nav.xhtml">目次</a></li>', F.coalesce(lit('<li><a epub:type="bodymatter" href="', first, f'">{UNTITLED}</a></li>'), F.lit("")))
    body = lit('<nav epub:type="toc" id="toc"><h1>目次</h1>', F.coalesce("html", fallback), '</nav>\n<nav epub:type="landmarks" id="landmarks" hidden=""><ol>', marks, "</ol></nav>")
    page = lit(XHTML_HEAD.format(lang="ja"), '目次</title>\n<link rel="stylesheet" type="text/css" href="style.css"/></head>\n<body>\n', body, "\n</body>\n</html>\n")
    return j.select("book_id", page.alias("xhtml"))


def ncx(nav: DataFrame, books: DataFrame) -> DataFrame:
    """(book_id, ncx); nav with play_order, books: book_id, title, identifier, first_href."""
    point = lambda kids: lit(
        '<navPoint id="navPoint-', F.col("node_id").cast("string"), '" playOrder="', F.col("play_order").cast("string"), '">\n<navLabel><text>', X.render_plain(F.col("title")),
        '</text></navLabel>\n<content src="', X.escape_attr(F.col("href")), '"/>\n', kids, "</navPoint>\n",
    )
    points = nested(nav, point, lambda inner: inner).withColumnRenamed("html", "_points")
    j = books.join(points, "book_id", "left").join(nav.groupBy("book_id").agg(F.max("depth").alias("_depth")), "book_id", "left")
    lone = lit(f'<navPoint id="navPoint-1" playOrder="1">\n<navLabel><text>{UNTITLED}</text></navLabel>\n<content src="', F.coalesce(X.escape_attr(F.col("first_href")), F.lit("nav.xhtml")), '"/>\n</navPoint>\n')
    meta = lambda name, value: lit(f'<meta name="dtb:{name}" content="', value, '"/>\n')
    head = lit(meta("uid", X.escape_attr(F.col("identifier"))), meta("depth", F.coalesce("_depth", F.lit(1)).cast("string")), meta("totalPageCount", F.lit("0")), meta("maxPageNumber", F.lit("0")))
    doc = lit(
        '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE ncx PUBLIC "-//NISO//DTD ncx 2005-1//EN" "http://www.daisy.org/z3986/2005/ncx-2005-1.dtd">\n<ncx xmlns="http://www.daisy.org/z3986/2005/ncx/" version="2005-1" xml:lang="ja">\n<head>\n',
        head, "</head>\n<docTitle><text>", X.render_plain(F.col("title")), "</text></docTitle>\n<navMap>\n", F.coalesce("_points", lone), "</navMap>\n</ncx>\n",
    )
    return j.select("book_id", doc.alias("ncx"))


def primary_writing_mode(horizontal: bool) -> str:
    """T29."""
    return "horizontal-lr" if horizontal else "vertical-rl"


def css(horizontal: bool) -> str:
    """The style sheet; only the writing mode, what belongs to it and tables are set."""
    mode = "horizontal-tb" if horizontal else "vertical-rl"
    prefixed = "".join(f"  {p}writing-mode: {mode};\n" for p in ("-epub-", "-webkit-", ""))
    rules = [f"html, body {{\n{prefixed}  margin: 0;\n}}", "p { margin: 0; text-indent: 1em; }", "p.subtitle { text-indent: 0; }", "table.h-table { border-collapse: collapse; writing-mode: horizontal-tb; }", "figure.h-figure { margin: 1em; text-align: center; }"]
    if not horizontal:
        rules += [".tcy { -epub-text-combine: horizontal; -webkit-text-combine: horizontal; text-combine-upright: all; }", "table.h-table .tcy { text-combine-upright: none; }"]
    return "\n".join(rules) + "\n"


def opf(books: DataFrame, manifest: DataFrame, spine: DataFrame, horizontal: bool = False, ncx_id: str | None = "ncx") -> DataFrame:
    """(book_id, opf); books: book_id, title, author, publisher, identifier, modified; manifest and spine have pos."""
    listed = lambda d, row, name: d.groupBy("book_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", row.alias("r")))), lambda s: s["r"]), "\n").alias(name))
    item = lit('<item id="', F.col("id"), '" href="', F.col("href"), '" media-type="', F.col("media_type"), '"', F.when(F.coalesce("properties", F.lit("")) != "", lit(' properties="', F.col("properties"), '"')).otherwise(""), "/>")
    ref = lit('<itemref idref="', F.col("idref"), '"', F.when(F.coalesce("linear", F.lit("")) != "", lit(' linear="', F.col("linear"), '"')).otherwise(""), "/>")
    j = books.join(listed(manifest, item, "_items"), "book_id", "left").join(listed(spine, ref, "_refs"), "book_id", "left")
    part = lambda name, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", lit(f"<dc:{name}>", X.escape(F.col(c)), f"</dc:{name}>\n")).otherwise("")
    attributes = (f' toc="{ncx_id}"' if ncx_id else "") + ("" if horizontal else ' page-progression-direction="rtl"')
    doc = lit(
        '<?xml version="1.0" encoding="UTF-8"?>\n<package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="pub-id" xml:lang="ja">\n<metadata xmlns:dc="http://purl.org/dc/elements/1.1/">\n<dc:identifier id="pub-id">',
        F.col("identifier"), "</dc:identifier>\n<dc:title>", X.escape(F.col("title")), "</dc:title>\n<dc:language>ja</dc:language>\n", part("creator", "author"), part("publisher", "publisher"),
        '<meta property="dcterms:modified">', F.col("modified"), f'</meta>\n<meta name="primary-writing-mode" content="{primary_writing_mode(horizontal)}"/>\n</metadata>\n<manifest>\n',
        F.coalesce("_items", F.lit("")), f"\n</manifest>\n<spine{attributes}>\n", F.coalesce("_refs", F.lit("")), "\n</spine>\n</package>\n",
    )
    return j.select("book_id", doc.alias("opf"))


def zip_books(entries: DataFrame) -> DataFrame:
    """(book_id, epub) of entries(book_id, pos, name, bytes); the type comes first and stored, the rest deflated."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(zipfile.ZipInfo("mimetype"), MIMETYPE, zipfile.ZIP_STORED)
            z.writestr(zipfile.ZipInfo("META-INF/container.xml"), CONTAINER, zipfile.ZIP_DEFLATED)
            for name, data in group.sort_values("pos")[["name", "bytes"]].itertuples(index=False):
                z.writestr(zipfile.ZipInfo(name), bytes(data), zipfile.ZIP_DEFLATED)
        return pd.DataFrame({"book_id": [group["book_id"].iloc[0]], "epub": [out.getvalue()]})

    return entries.groupBy("book_id").applyInPandas(pack, "book_id string, epub binary")


def read_zips(books: DataFrame) -> DataFrame:
    """(book_id, pos, name, stored, bytes) of books(book_id, epub)."""

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for book, data in f[["book_id", "epub"]].itertuples(index=False):
                with zipfile.ZipFile(io.BytesIO(bytes(data))) as z:
                    rows = [(book, k, i.filename, i.compress_type == zipfile.ZIP_STORED, z.read(i)) for k, i in enumerate(z.infolist())]
                yield pd.DataFrame(rows, columns=["book_id", "pos", "name", "stored", "bytes"])

    return books.select("book_id", "epub").mapInPandas(entries, "book_id string, pos int, name string, stored boolean, bytes binary")


def crop_boxes(figures: DataFrame, pad: int = 6) -> DataFrame:
    """(book_id, page, src, left, top, right, bottom) of figures(book_id, page, src, box, width, height): whole
    pixels, padded, kept within the page. Cutting the raster is the provider's part, a page at a time."""
    side = lambda k: F.col("box")[k].cast("int")
    return figures.select(
        "book_id", "page", "src", F.greatest(F.lit(0), side(0) - pad).alias("left"), F.greatest(F.lit(0), side(1) - pad).alias("top"),
        F.least(F.col("width"), side(2) + pad).alias("right"), F.least(F.col("height"), side(3) + pad).alias("bottom"),
    )


def plain_lines(blocks: DataFrame, figures: str) -> DataFrame:
    """Blocks with `out`, the lines of the plain-text format."""
    keys = ["book_id", "seq"]
    cells = cell_texts(blocks.where("kind = 'table'"), keys)
    rows = cells.where("cell_text <> ''").groupBy(*keys, "row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("col", "cell_text"))), lambda s: s["cell_text"]), "　").alias("line"))
    tables = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("row", "line"))).alias("_rows"))
    b = blocks.join(tables, keys, "left")
    kind, level = F.col("kind"), F.col("level")

    def head(parts: Column) -> Column:
        one = F.array(lit(parts[0], "［＃「", parts[0], "」は", level, "見出し］"))
        more = F.concat(F.array(lit("［＃ここから", level, "見出し］")), parts, F.array(lit("［＃ここで", level, "見出し終わり］")))
        some = F.when(F.size(parts) == 0, F.array().cast("array<string>")).when(F.size(parts) == 1, one).otherwise(more)
        return F.when(level == "大", F.concat(F.array(F.lit(PAGE_BREAK)), some)).otherwise(some)

    filled = lambda t, s: F.when(F.coalesce(t, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(lit(s, t)))
    line = lambda r: F.coalesce(F.element_at(F.col("_rows"), r), F.lit(""))
    grid = F.when(F.col("n_row") > 0, F.transform(F.sequence(F.lit(1), F.greatest(F.col("n_row"), F.lit(1))), line)).otherwise(F.array().cast("array<string>"))
    out = (
        F.when(kind == "para", X.let(X.normalize(X.join_lines(F.col("lines"))), lambda t: filled(t, "　")))
        .when(kind == "raw", filled(F.col("text"), ""))
        .when(kind == "heading", X.let(heading_parts(F.col("lines")), head))
        .when(kind == "table", F.concat(F.array(F.lit(BOX_START)), grid, F.array(F.lit(BOX_END))))
        .when(kind == "figure", F.array(lit(f"［＃挿絵（{figures}/", F.col("src"), "）入る］")))
    )
    return b.withColumn("out", out).drop("_rows")


def plain_text(blocks: DataFrame, figures: str, header: Column | None = None, footer: Column | None = None) -> DataFrame:
    """(book_id, text, paragraphs, headings, tables, pictures); header and footer are columns of blocks, the
    same for all of a book; more than two line breaks become two."""
    b = plain_lines(blocks, figures)
    lines = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("seq", "out"))), lambda s: s["out"]))
    count = lambda kind, more="true": F.count(F.when((F.col("kind") == kind) & F.expr(more), 1))
    ends = [F.first(h if h is not None else F.lit("")).alias(n) for h, n in ((header, "_h"), (footer, "_f"))]
    t = b.groupBy("book_id").agg(
        F.regexp_replace(F.array_join(lines, "\n"), r"^\n+", "").alias("body"), count("para", "size(out) > 0").alias("paragraphs"), count("heading").alias("headings"),
        count("table").alias("tables"), count("figure").alias("pictures"), *ends,
    )
    return t.select("book_id", F.regexp_replace(F.concat("_h", "body", "_f"), r"\n{3,}", "\n\n").alias("text"), "paragraphs", "headings", "tables", "pictures")
