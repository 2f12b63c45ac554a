"""Personal data by patterns and information-theoretic sanitisation (operator 9). DataFrame functions only.

Patterns find the base spans (email, ip, card, phone). Each value found is a protected entity. Words of the
documents that hold an entity reveal it as far as the corpus says so. All counts are of whole documents, equal
texts being one: with N documents, n(e) holding entity e, df(t) word t and n(e, t) both, the pointwise mutual
information log2(n(e, t) N / (n(e) df(t))) is compared with what the entity itself tells, log2(N / n(e)). Words
at or above ``DISCLOSURE`` of it become spans of kind "term" wherever they stand in a document that holds the
entity; base spans always stay. Rare entities count like others; chance is kept out by the mutual information of
both over all documents, which must be significant (``EVIDENCE``). ``redact`` generalises every span to its kind in
brackets.

Where spans begin follows from the lengths of what lies between matches: one row a match, summed inside
its text. Document frequencies are counted over the whole corpus. They meet the words of the documents that hold an
entity first, so words meet only entities that they could disclose; entities of the very same documents are
one to the counts, so a list of many addresses that stand nowhere else meets the words of its text once. All steps are
linear in a text's length: patterns start only where a run of their characters starts, terms and overlaps are
found on rows, and texts are put together again from blocks of ``BLOCK`` code points.

Defined results: null and empty texts have no spans; rows that share doc_id and text have equal results;
rows without doc_id are treated like others; empty tables give no rows; other columns pass unchanged and
helper columns carry a prefix of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import row_key, staged, text_of

# The kinds in order, with the pattern of each. A repeated group is possessive and captures nothing:
# others recurse once a repetition in Java, and a long text then overflows the stack, which ends the executor. A match of
# an e-mail or ip begins where its run of characters begins, or where the match before it ended in that run (\G): a later
# start would run to the same end and fail alike, and trying it makes long runs quadratic.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap tests that every text with a match passes.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"\p{L}{3,}"
DISCLOSURE = 0.5
#: Code points of a text that are put together at a time.
BLOCK = 1024
#: Critical value of the chi-square distribution of one degree of freedom at a level of 0.0001.
EVIDENCE = 15.137


def text_key() -> Column:
    """Identifies a text; rows of equal texts are one document to the counts."""
    return F.xxhash64(text_of())


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the digits pass Luhn: every second one from the right doubled, the sum a multiple of ten."""
    marks = F.split(F.reverse(_digits(value)), "")
    marks = F.filter(marks, lambda d: d != "")
    doubled = F.transform(marks, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.expr("0") + (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _holds(kind: Column, value: Column) -> Column:
    """Whether a match of its kind's pattern is kept."""
    byte = r"0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    n = F.length(_digits(value))
    return (F.when(kind == "email", True)
            .when(kind == "ip", value.rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}$"))
            .when(kind == "card", n.between(16, 19) & _luhn(value))
            .otherwise(n.between(8, 15)))


def _matches(kind: str) -> Column:
    """Array of (kind, i, gap, value) of one pattern's matches in the text ``_t``; gap: code points before it."""
    text, pattern = F.col("_t"), PATTERNS[kind]
    pieces, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.transform(F.arrays_zip(pieces.alias("gap"), values.alias("value")), lambda m, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(m["gap"]).alias("gap"), m["value"].alias("value")))
    found = F.filter(found, lambda m: m["value"].isNotNull())
    hint = HINTS[kind]
    may = F.contains(text, F.lit(hint)) if hint else text.rlike("[0-9]")
    return F.when(may, found).otherwise(F.filter(F.array(F.struct(
        F.lit(kind).alias("kind"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("value"))),
        lambda m: F.lit(False)))


def holders(docs: DataFrame) -> DataFrame:
    """_key, _id, _text, _t and all matches (_m) of the rows that hold an entity."""
    rows = docs.select(row_key().alias("_key"), F.col("doc_id").alias("_id"), text_key().alias("_text"), text_of().alias("_t"))
    found = F.concat(*[_matches(k) for k in KINDS])
    # inside one expression, so that the patterns are run once a text
    held = F.filter(F.array(found), lambda found: F.exists(found, lambda m: _holds(m["kind"], m["value"])))
    return rows.select("_key", "_id", "_text", "_t", F.explode(held).alias("_m"))


def base_spans(rows: DataFrame) -> DataFrame:
    """_key, _id, _text, kind, start, end, value of every base span (code points, end exclusive) of ``holders``."""
    rows = (rows.select("_key", "_id", "_text", F.explode("_m").alias("m")).select("_key", "_id", "_text", "m.*")
            .dropDuplicates(["_key", "_id", "kind", "i"]))
    order = Window.partitionBy("_key", "_id", "kind").orderBy("i")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("value")
    start = F.sum("gap").over(upto) + F.coalesce(F.sum(size).over(before), F.lit(0))
    return (rows.withColumn("start", start.cast("long")).withColumn("end", F.col("start") + size)
            .filter(_holds(F.col("kind"), F.col("value"))).drop("i", "gap"))


def _tells(together: Column, n_e: Column, df: Column, n: float, disclosure: float) -> Column:
    """Whether counts of documents show that a word discloses an entity: their pointwise mutual information
    reaches its share of the entity's own, and 2 N times their mutual information (the G statistic of the four
    counts) reaches ``EVIDENCE``."""
    def cell(count: Column, row: Column, column: Column) -> Column:
        return F.when(count > 0, count * F.log(count * n / (row * column))).otherwise(0.0)

    k, e, t = (c.cast("double") for c in (together, n_e, df))
    g = 2 * (cell(k, e, t) + cell(e - k, e, n - t) + cell(t - k, n - e, t) + cell(n - e - t + k, n - e, n - t))
    own = F.log(n / e)
    return (own > 0) & (F.log(k * n / (e * t)) >= own * disclosure * (1 - 1e-12)) & (g >= EVIDENCE)


def _words(text: Column) -> Column:
    """The distinct words of a text in lower case."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))
    return F.array_distinct(F.transform(found, F.lower))


def document_frequencies(docs: DataFrame) -> DataFrame:
    """term, df: documents that hold each word; equal texts are one document."""
    texts = docs.select(text_key().alias("_text"), text_of().alias("_t")).dropDuplicates(["_text"])
    return (texts.select(F.explode(_words(F.col("_t"))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))  # counted in the map tasks first


def disclosing_terms(docs: DataFrame, rows: DataFrame, base: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """_text, term: the words of each text that disclose an entity it holds."""
    n = float(docs.select(text_key()).distinct().count())
    held = base.select("_text", F.concat_ws(":", "kind", "value").alias("entity")).distinct()
    # entities of the same documents are one: their number of documents and two sums over the documents' hashes agree
    groups = held.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_e"), F.sum(F.col("_text").cast("decimal(20,0)")).alias("_s"),
        F.bit_xor(F.xxhash64("_text", F.lit("entity"))).alias("_x"))
    group = F.concat_ws(":", "n_e", "_s", "_x").alias("group")
    held = staged(held.join(groups.select("entity", group), "entity").select("_text", F.col("group").alias("entity")).distinct(), "held")
    entities = staged(held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e")), "entities")
    most = entities.agg(F.max("n_e")).first()[0]
    df = staged(document_frequencies(docs), "document-frequencies")
    # no entity can be told by words above this; those of a hundredth of the documents (at most 100 times the words of
    # a document) are taken out before words meet their frequencies by key
    top = n * ((most or 1) / max(n, 1.0)) ** disclosure * (1 + 1e-9)
    common = df.filter((F.col("df") > top) & (F.col("df") > n / 100)).select("term")
    words = rows.select("_text", F.explode(_words(F.col("_t"))).alias("term")).join(F.broadcast(common), "term", "left_anti")
    words = words.distinct().join(df.filter(F.col("df") <= top), "term")
    might = _tells(F.least("n_e", "df"), F.col("n_e"), F.col("df"), n, disclosure)  # if together wherever they can be
    pairs = staged(words.join(held.join(entities, "entity"), "_text").filter(might), "pairs")
    told = (pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_et"), F.max("n_e").alias("n_e"), F.max("df").alias("df"))
            .filter(_tells(F.col("n_et"), F.col("n_e"), F.col("df"), n, disclosure)))
    return pairs.join(told, ["entity", "term"], "left_semi").select("_text", "term").distinct()


def term_spans(rows: DataFrame, told: DataFrame) -> DataFrame:
    """_key, _id, start, end of every occurrence of the ``told`` terms (_text, term) in ``rows``, one row a word on the way."""
    told = told.select(F.col("_text").alias("_of"), "term")
    texts = rows.select("_key", "_id", "_text", "_t").join(told.select("_of").distinct(), F.col("_text") == F.col("_of"), "left_semi")
    pieces, values = F.split("_t", TERM, -1), F.regexp_extract_all(F.col("_t"), F.lit(TERM), F.lit(0))
    words = (texts.dropDuplicates(["_key", "_id"])
             .select("_key", "_id", "_text", F.posexplode(F.arrays_zip(pieces.alias("g"), values.alias("w"))).alias("i", "p"))
             .select("_key", "_id", "_text", "i", F.length("p.g").alias("gap"), F.col("p.w").alias("word")))
    order = Window.partitionBy("_key", "_id").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.coalesce(F.length("word"), F.lit(0))
    words = words.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("end") - size)
    return (words.join(told, (F.col("_text") == F.col("_of")) & (F.lower("word") == F.col("term")))
            .select("_key", "_id", F.col("start").cast("long"), F.col("end").cast("long")))


def spans(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """_key, _id, k (number of the kind, terms last), s, e of every span; a term never overlaps a base span."""
    rows = staged(holders(docs), "holders")
    base = staged(base_spans(rows), "base-spans")
    told = staged(disclosing_terms(docs, rows, base, disclosure), "told")
    number = F.lit(len(KINDS))
    for i, k in enumerate(KINDS):
        number = F.when(F.col("kind") == k, i).otherwise(number)
    every = (base.select("_key", "_id", number.alias("k"), "start", "end")
             .unionByName(term_spans(rows, told).withColumn("k", F.lit(len(KINDS))))
             .select("_key", "_id", "k", F.col("start").alias("s"), F.col("end").alias("e")))
    fixed = F.col("k") < len(KINDS)
    own = Window.partitionBy("_key", "_id").orderBy("s")
    ended = F.max(F.when(fixed, F.col("e"))).over(own.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    begins = F.min(F.when(fixed, F.col("s"))).over(own.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    every = every.withColumns({"_ended": ended, "_begins": begins})
    clear = F.coalesce(F.col("_ended") <= F.col("s"), F.lit(True)) & F.coalesce(F.col("_begins") >= F.col("e"), F.lit(True))
    return staged(every.filter(fixed | clear).select("_key", "_id", "k", "s", "e"), "spans")


def spans_by_row(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """_key, _id, spans (array of kind number, start, end; sorted by kind, then start) of rows with any."""
    return spans(docs, disclosure).groupBy("_key", "_id").agg(F.array_sort(F.collect_list(F.struct("k", "s", "e"))).alias("spans"))


def _is_kind(number: int):
    return lambda x: x["k"] == number


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "term")])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row."""
    found = spans_by_row(docs, disclosure)
    none = F.array().cast("array<struct<k:int,s:bigint,e:bigint>>")
    rows = docs.select("doc_id", row_key().alias("_row"))
    out = rows.join(found, (F.col("_row") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    out = out.withColumn("spans", F.coalesce(F.col("spans"), none))
    counts = [F.size(F.filter("spans", _is_kind(i))).cast("long").alias(f"n_{k}")
              for i, k in enumerate(KINDS)]
    base = _joined(F.filter("spans", lambda x: x["k"] < len(KINDS)))
    return out.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _rewritten(docs: DataFrame, found: DataFrame) -> DataFrame:
    """_key, _id, _new: the texts of the rows with ``found`` spans, each span as its kind in brackets. Spans and text are
    cut into blocks of ``BLOCK`` code points, so that no step handles a whole text for each of its spans."""
    names = F.array(*[F.lit(f"[{k}]") for k in (*KINDS, "term")])
    order = Window.partitionBy("_key", "_id").orderBy("s", "e", "k")
    before = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    kept = found.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("s") >= F.col("_before")))
    cut = (kept.withColumn("b", F.explode(F.expr(f"sequence(s div {BLOCK}, greatest(s, e - 1) div {BLOCK})")))
           .select("_key", "_id", "b", F.greatest(F.col("s") - F.col("b") * BLOCK, F.lit(0)).cast("int").alias("s"),
                   F.least(F.col("e") - F.col("b") * BLOCK, F.lit(BLOCK)).cast("int").alias("e"),
                   F.when(F.expr(f"s div {BLOCK}") == F.col("b"), F.element_at(names, F.col("k") + 1)).otherwise("").alias("name"))
           .groupBy("_key", "_id", "b").agg(F.array_sort(F.collect_list(F.struct("s", "e", "name"))).alias("_cut")))
    blocks = F.regexp_extract_all(text_of(), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    rows = found.select(F.col("_key").alias("_k"), F.col("_id").alias("_i")).distinct()
    texts = (docs.select(row_key().alias("_key"), F.col("doc_id").alias("_id"), "text")
             .join(rows, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")), "left_semi")
             .dropDuplicates(["_key", "_id"])
             .select("_key", "_id", F.posexplode(blocks).alias("b", "_t")))
    cut = cut.select(F.col("_key").alias("_k"), F.col("_id").alias("_i"), F.col("b").alias("_b"), "_cut")
    texts = texts.join(cut, (F.col("_key") == F.col("_k")) & F.col("_id").eqNullSafe(F.col("_i")) & (F.col("b") == F.col("_b")), "left")
    block = F.col("_t")
    parts = F.transform("_cut", lambda x, i: F.concat(
        block.substr(F.when(i == 0, 1).otherwise(F.get("_cut", i - 1)["e"] + 1), x["s"] - F.when(i == 0, 0).otherwise(F.get("_cut", i - 1)["e"])),
        x["name"]))
    whole = F.concat(F.array_join(parts, ""), block.substr(F.element_at("_cut", -1)["e"] + 1, F.lit(BLOCK)))
    texts = texts.select("_key", "_id", "b", F.when(F.col("_cut").isNull(), block).otherwise(whole).alias("_t"))
    return (texts.groupBy("_key", "_id").agg(F.array_sort(F.collect_list(F.struct("b", "_t"))).alias("_t"))
            .select("_key", "_id", F.array_join(F.col("_t._t"), "").alias("_new")))


def redact(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """``docs`` with every span generalised to its kind, as in "[email]"; n_chars, where it exists, follows.
    Overlapping spans become the one that starts first."""
    new = _rewritten(docs, spans(docs, disclosure))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_all"), row_key().alias("_row"))
    rows = rows.join(new, (F.col("_row") == F.col("_key")) & F.col("_all.doc_id").eqNullSafe(F.col("_id")), "left")
    out = []
    for c in docs.columns:
        value = F.col(f"_all.`{c}`")
        if c == "text":
            value = F.coalesce("_new", value)
        elif c == "n_chars":
            value = F.when(F.col("_new").isNull(), value).otherwise(F.length("_new")).cast(docs.schema[c].dataType)
        out.append(value.alias(c))
    return rows.select(*out)
