"""Masking methods over derived personal data and whole texts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from lethe.functions.drawing import FIRST_NAMES, LAST_NAMES
from lethe.functions.fpe import TEXT_ALPHABET
from lethe.operators.masking import apply_rules
from lethe.sources.readers import spread
from lethe.specs import Rule

QUERIES, ORACLES = {}, {}

# --- DuckDB wording of the masks -------------------------------------------------


def seed(column: str, value: str) -> str:
    return f"sha256(concat_ws('|', sha256('{fx.CHECK_KEY}|{column}'), coalesce(CAST({value} AS VARCHAR), '')))"


def number(hexadecimal: str, start: int, digits: int) -> str:
    return f"CAST('0x' || substr({hexadecimal}, {start}, {digits}) AS BIGINT)"


def block(s: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN {s} ELSE sha256({s} || '|' || CAST({b} AS VARCHAR)) END"


# Base -> symbols of a 60-bit number, symbols kept of them.
BASES = {10: (19, 15), 26: (13, 11), 36: (12, 9)}


def slice_of(h: str, k: int, base: int) -> str:
    width, kept = BASES[base]
    return f"substr(to_base({number(h, 15 * k + 1, 15)}, {base}, {width}), {width - kept + 1}, {kept})"


def as_letters(text: str) -> str:
    return f"translate({text}, '0123456789ABCDEFGHIJKLMNOP', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')"


def drawn(s: str, length: str, base: int) -> str:
    """Characters of a base for a seed, all slices of as many hashes as the length needs."""
    per_hash = 4 * BASES[base][1]
    h = block(s, "b")
    slices = " || ".join(slice_of(f"({h})", k, base) for k in range(4))
    text = (
        f"substr(array_to_string(list_transform(range(0, 1 + greatest({length} - 1, 0) // {per_hash}), "
        f"lambda b: {slices}), ''), 1, {length})"
    )
    return {10: text, 26: as_letters(text), 36: f"lower({text})"}[base]


def along(chars: str, body: str) -> str:
    """Text of ``body`` for each position i of a list of characters."""
    return f"array_to_string(list_transform(range(1, len({chars}) + 1), lambda i: {body}), '')"


def chars_of(text: str) -> str:
    return f"regexp_extract_all({text}, '(?s).')"


SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def streams(chars: str, s: str) -> str:
    """Select items ds and ls: digits and letters for each block of 42 characters."""
    blocks = f"range(0, 1 + greatest(len({chars}) - 1, 0) // 42)"
    signs = f"to_base64(from_hex({block(s, 'b')}))"
    digits = "".join(str(i % 10) for i in range(64))
    letters = "".join(chr(65 + i % 26) for i in range(64))
    return (
        f"list_transform({blocks}, lambda b: translate({signs}, '{SIGNS}', '{digits}')) AS ds, "
        f"list_transform({blocks}, lambda b: translate({signs}, '{SIGNS}', '{letters}')) AS ls"
    )


def substituted(chars: str) -> str:
    """Letters and digits of a list of characters replaced from ds and ls."""
    at = "CAST((i - 1) // 42 + 1 AS INT)], CAST((i - 1) % 42 + 1 AS INT), 1)"
    c = f"{chars}[i]"
    return along(chars, f"""CASE WHEN {c} BETWEEN '0' AND '9' THEN substr(ds[{at} WHEN {c} BETWEEN 'A' AND 'Z'
      THEN substr(ls[{at} WHEN {c} BETWEEN 'a' AND 'z' THEN lower(substr(ls[{at}) ELSE {c} END""")


def digits_replaced(text: str, digits: str) -> str:
    c = f"{chars_of(text)}[i]"
    return along(chars_of(text), f"CASE WHEN {c} BETWEEN '0' AND '9' THEN substr({digits}, CAST(i AS INT), 1) ELSE {c} END")


def unless_null(value: str, body: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN {body} END"


def words(column: str) -> str:
    return f"CASE WHEN {column} IN ('null', 'NULL', 'Null') THEN NULL ELSE {column} END"


def names(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def numeric(column: str, dtype: str) -> str:
    """The k-th digit of the printed number becomes the k-th drawn digit."""
    text = f"CAST({column} AS VARCHAR)"
    s = seed(column, column)
    digits = drawn(s, "30", 10)
    lead = f"CAST(1 + {number(s, 61, 4)} % 9 AS VARCHAR)"
    c = f"substr({text}, CAST(i AS INT), 1)"
    nth = f"length(regexp_replace(substr({text}, 1, CAST(i AS INT)), '[^0-9]', '', 'g'))"
    plain = (
        f"array_to_string(list_transform(range(1, length({text}) + 1), lambda i: "
        f"CASE WHEN {c} BETWEEN '0' AND '9' THEN substr({digits}, {nth}, 1) ELSE {c} END), '')"
    )
    kept = (
        f"CASE WHEN regexp_extract({text}, '[0-9]') = '0' THEN {plain} "
        f"ELSE regexp_replace({plain}, '^([^0-9]*)0', '\\1' || {lead}) END"
    )
    return unless_null(
        column,
        f"coalesce(TRY_CAST({kept} AS {dtype}), "
        f"TRY_CAST(regexp_replace({kept}, '^([^0-9]*)[0-9]', '\\11') AS {dtype}))",
    )


def permuted(column: str, table: str, key: str) -> str:
    return f"""
      SELECT {key}, coalesce(lead({column}) OVER w,
          first_value({column}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {column}
      FROM {table} WHERE {column} IS NOT NULL
      WINDOW w AS (ORDER BY {number(seed(column, key), 1, 15)}, {key}, {column})
      UNION ALL SELECT {key}, {column} FROM {table} WHERE {column} IS NULL"""


ROW = "c_custkey"


def iban_sql() -> str:
    fold = (
        "list_reduce(list_transform(range(1, length(u) + 1), lambda i: ascii(substr(u, CAST(i AS INT), 1))), "
        "lambda r, c: CASE WHEN c < 65 THEN (r * 10 + c - 48) % 97 ELSE (r * 100 + c - 55) % 97 END, 0)"
    )
    return f"""
      WITH base AS MATERIALIZED (SELECT c_custkey, iban, {seed('iban', 'iban')} AS s,
        {chars_of('substr(iban, 5)')} AS a, {chars_of('iban')} AS w FROM pii),
      blocks AS MATERIALIZED (SELECT *, {streams('w', 's')} FROM base),
      body AS MATERIALIZED (SELECT *, {substituted('a')} AS m, {substituted('w')} AS whole FROM blocks),
      bare AS MATERIALIZED (SELECT *, upper(m || substr(iban, 1, 2)) || '00' AS u FROM body)
      SELECT c_custkey, CASE WHEN iban IS NULL THEN NULL
        WHEN regexp_matches(iban, '^[A-Za-z]{{2}}[0-9]{{2}}')
          THEN substr(iban, 1, 2) || lpad(CAST(98 - {fold} AS VARCHAR), 2, '0') || m
        ELSE whole END AS iban FROM bare"""


# --- Registration ------------------------------------------------------------------


def over_pii(name: str, column: str, method: str, expression: str | None, options: dict | None = None,
             statement: str | None = None) -> None:
    """A query that masks one column of the derived personal data."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        masked = apply_rules(fx.pii(spark, sf_dir), [Rule(column, method, options or {})], fx.context(ROW))
        return masked.select(ROW, column)

    QUERIES[name] = query
    if statement is None:
        statement = f"SELECT {ROW}, {expression} AS {column} FROM pii"
    body = statement.strip()
    with_pii = f"WITH pii AS MATERIALIZED ({fx.PII_DUCK})"
    if body.upper().startswith("WITH "):
        ORACLES[name] = f"{with_pii}, {body[5:]}"
    else:
        ORACLES[name] = f"{with_pii} {body}"


def over_table(name: str, table: str, key: tuple[str, ...], column: str, method: str, statement: str,
               options: dict | None = None) -> None:
    """A query that masks one column of a given table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fx.table(spark, sf_dir, table).select(*key, column)
        return apply_rules(df, [Rule(column, method, options or {})], fx.context(*key))

    QUERIES[name] = query
    ORACLES[name] = statement


label = f"({words('label')})"
over_pii("mask_id", "label", "id", None, statement=f"""
  WITH b AS MATERIALIZED (SELECT c_custkey, {label} AS label FROM pii),
  s AS MATERIALIZED (SELECT *, {seed('label', 'label')} AS s, {chars_of('label')} AS a FROM b),
  d AS MATERIALIZED (SELECT *, {streams('a', 's')} FROM s)
  SELECT c_custkey, {unless_null('label', substituted('a'))} AS label FROM d""")

# Whole documents.
over_table("mask_chaine", "documents", ("doc_id",), "text", "chaine", f"""
  WITH b AS MATERIALIZED (SELECT doc_id, {words('text')} AS text FROM documents),
  s AS MATERIALIZED (SELECT doc_id, text, {seed('text', 'text')} AS s, {chars_of('text')} AS a FROM b),
  d AS MATERIALIZED (SELECT *, {streams('a', 's')} FROM s)
  SELECT doc_id, {unless_null('text', substituted('a'))} AS text FROM d""")
over_pii("mask_numeric", "amount_int", "numeric", numeric("amount_int", "INT"))
over_pii("mask_numeric_long", "amount_long", "numeric", numeric("amount_long", "BIGINT"))
over_pii("mask_numeric_double", "amount_double", "numeric", numeric("amount_double", "DOUBLE"))
tel_seed = seed("tel", "tel")
tel_plain = digits_replaced("tel", drawn(tel_seed, "length(tel)", 10))
over_pii("mask_numeric_text", "tel", "numeric", unless_null("tel", f"""CASE WHEN regexp_extract(tel, '[0-9]') = '0'
  THEN {tel_plain} ELSE regexp_replace({tel_plain}, '^([^0-9]*)0',
    '\\1' || CAST(1 + {number(tel_seed, 61, 4)} % 9 AS VARCHAR)) END"""))
over_pii("mask_iban", "iban", "iban", None, statement=iban_sql())
row = {c: seed(c, ROW) for c in (
    "name", "email", "tel", "label", "amount_int", "amount_long", "amount_double", "birth", "optin")}
over_pii("mask_firstname", "name", "firstname",
         unless_null("name", f"{names(FIRST_NAMES)}[{number(row['name'], 1, 8)} % {len(FIRST_NAMES)} + 1]"))
NAMES_DUCK = "(SELECT list(DISTINCT p_name ORDER BY p_name) AS names FROM part WHERE p_name IS NOT NULL) AS n"


def mask_firstname_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names drawn from a table, here the names of all parts."""
    context = replace(fx.context(ROW), first_table=fx.table(spark, sf_dir, "part").select("p_name"))
    return apply_rules(fx.pii(spark, sf_dir), [Rule("name", "firstname")], context).select(ROW, "name")


QUERIES["mask_firstname_table"] = mask_firstname_table
ORACLES["mask_firstname_table"] = f"""WITH pii AS MATERIALIZED ({fx.PII_DUCK})
  SELECT {ROW}, {unless_null("name", f"names[{number(row['name'], 1, 15)} % len(names) + 1]")} AS name FROM pii, {NAMES_DUCK}"""
over_pii("mask_lastname", "name", "lastname",
         unless_null("name", f"{names(LAST_NAMES)}[{number(row['name'], 1, 8)} % {len(LAST_NAMES)} + 1]"))
last4 = "regexp_extract(card, '([0-9][^0-9]*){4}$')"
over_pii("mask_card", "card", "card", f"""CASE WHEN length(regexp_replace(card, '[^0-9]', '', 'g')) <= 4 THEN card
  ELSE translate(substr(card, 1, length(card) - length({last4})), '0123456789', 'XXXXXXXXXX') || {last4} END""")
over_pii("mask_email", "email", "email",
         unless_null("email", drawn(row["email"], "10", 36) + " || '@example.com'"))
domain = "regexp_extract(email, '@[^@]*$')"
over_pii("mask_email_domain", "email", "email", unless_null("email", drawn(
    row["email"], f"(length(email) - length({domain}))", 36) + f" || {domain}"), {"keep_domaine": "true"})
head = r"regexp_extract(tel, '^\+?[0-9]{2}')"
tail = f"substr(tel, length({head}) + 1)"
over_pii("mask_tel", "tel", "tel", unless_null("tel", f"{head} || {digits_replaced(tail, drawn(row['tel'], f'length({tail})', 10))}"))
area = number(row["tel"], 61, 4)
eight = drawn(row["tel"], "8", 10)
over_pii("mask_tel_new", "tel", "tel", unless_null("tel", f"'0' || CAST(1 + {area} % 5 AS VARCHAR) || {eight}"),
         {"keep_indicator": "false"})
over_pii("mask_tel_cell", "tel", "tel", unless_null("tel", f"'0' || CAST(6 + {area} % 2 AS VARCHAR) || {eight}"),
         {"keep_indicator": "false", "cell_phone": "true"})
over_pii("mask_blank_char", "label", "blankedWithChar",
         f"repeat('#', length(replace(replace({label}, 'Cus', ''), '/', '')))",
         {"char": "#", "remove_before_blank": "Cus;/"})
bare = "length(replace(replace(replace({0}, ' ', ''), '-', ''), '/', ''))"
over_pii("mask_x", "label", "XReplace", f"repeat('X', {bare.format(label)})")
over_table("mask_zero", "documents", ("doc_id",), "text", "0Replace",
           f"SELECT doc_id, repeat('0', {bare.format('(' + words('text') + ')')}) AS text FROM documents")
over_pii("mask_blank", "amount_int", "blank", "''")
over_pii("mask_blank_typed", "amount_double", "blank", "CAST(0 AS DOUBLE)", {"respect_type": "true"})
over_pii("mask_null", "birth", "null", "CAST(NULL AS DATE)", {"respect_type": "true"})
over_pii("mask_alpha", "label", "randomAlphabeticChars",
         unless_null(label, drawn(row["label"], f"length({label})", 26)))
over_pii("mask_alpha_len", "label", "randomAlphabeticChars",
         unless_null(label, drawn(row["label"], "40", 26)), {"length": "40"})


def spaced(base: int) -> str:
    text = drawn(row["label"], "length(label)", base)
    c = f"{chars_of('label')}[i]"
    return unless_null(
        label, along(chars_of("label"), f"CASE WHEN {c} = ' ' THEN ' ' ELSE substr({text}, CAST(i AS INT), 1) END")
    )


over_pii("mask_alpha_spaces", "label", "randomAlphabeticChars", spaced(26), {"preserve_spaces": "true"})
over_pii("mask_digits", "label", "randomNumericChars",
         unless_null(label, drawn(row["label"], f"length({label})", 10)))
over_pii("mask_digits_len", "label", "randomNumericChars",
         unless_null(label, drawn(row["label"], "5", 10)), {"length": "5"})
over_pii("mask_digits_spaces", "label", "randomNumericChars", spaced(10), {"preserve_spaces": "true"})
over_pii("mask_int", "amount_int", "randomInts",
         unless_null("amount_int", f"CAST(-50 + {number(row['amount_int'], 1, 15)} % 150 AS INT)"),
         {"int_bounds": "[-50;100]"})
over_pii("mask_long", "amount_long", "randomLongs",
         unless_null("amount_long", f"{number(row['amount_long'], 1, 15)} % 9007199254740992"))
over_pii("mask_float", "amount_double", "randomFloats",
         unless_null("amount_double", f"CAST({number(row['amount_double'], 1, 6)} / 16777216.0::DOUBLE AS FLOAT)"))
over_pii("mask_double", "amount_double", "randomDoubles", unless_null(
    "amount_double", f"0.5::DOUBLE + CAST({number(row['amount_double'], 1, 13)} AS DOUBLE) / 4503599627370496.0::DOUBLE"
    " * 1.0::DOUBLE"), {"double_bounds": "[0.5;1.5]"})
over_pii("mask_date", "birth", "randomDates",
         unless_null("birth", f"DATE '1970-01-01' + CAST({number(row['birth'], 1, 8)} % 18262 AS INT)"))
over_pii("mask_bool", "optin", "randomBooleans", unless_null("optin", f"{number(row['optin'], 1, 8)} % 2 = 1"))
over_table("mask_permute", "orders", ("o_orderkey",), "o_totalprice", "keepDistribution",
           permuted("o_totalprice", "orders", "o_orderkey"))
SPARSE = "(SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 20000 = 7 THEN l_comment_no END AS v FROM (SELECT *, l_partkey * 10 + l_linenumber AS l_comment_no FROM lineitem)) AS x"


def two_keys(column: str) -> str:
    return f"sha256(concat_ws('|', sha256('{fx.CHECK_KEY}|{column}'), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)))"


def permuted_lines(column: str, table: str) -> str:
    return f"""
      SELECT l_orderkey, l_linenumber, coalesce(lead({column}) OVER w,
          first_value({column}) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {column}
      FROM {table} WHERE {column} IS NOT NULL
      WINDOW w AS (ORDER BY {number(two_keys(column), 1, 15)}, l_orderkey, l_linenumber, {column})
      UNION ALL SELECT l_orderkey, l_linenumber, {column} FROM {table} WHERE {column} IS NULL"""


over_table("mask_permute_lines", "lineitem", ("l_orderkey", "l_linenumber"), "l_extendedprice", "keepDistribution",
           permuted_lines("l_extendedprice", "lineitem"))
TOGETHER = ("o_totalprice", "o_orderstatus", "o_orderdate")


def mask_permute_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three columns permuted, each by an order of its own, over one shuffle of the rows."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", *TOGETHER)
    return apply_rules(orders, [Rule(c, "keepDistribution") for c in TOGETHER], fx.context("o_orderkey"))


QUERIES["mask_permute_together"] = mask_permute_together
ORACLES["mask_permute_together"] = "SELECT * FROM (SELECT o_orderkey, o_custkey FROM orders) AS o " + " ".join(
    f"JOIN ({permuted(c, 'orders', 'o_orderkey')}) AS p{i} USING (o_orderkey)" for i, c in enumerate(TOGETHER))


def mask_permute_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with a value in one of some twenty thousand orders: each value moves to another row."""
    lines = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 20000 == 7, F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("v"))
    return apply_rules(lines, [Rule("v", "keepDistribution")], fx.context("l_orderkey", "l_linenumber"))


QUERIES["mask_permute_sparse"] = mask_permute_sparse
ORACLES["mask_permute_sparse"] = permuted_lines("v", SPARSE)


def mask_id_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and customers masked under one key domain still join."""
    rule = {"domain": "customer"}
    # The mask depends on the value alone, so the orders of one customer are masked together.
    orders = fx.table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("string").alias("cust")).agg(F.count("*").alias("n"))
    customers = spread(fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("client"), "c_mktsegment"))
    left = apply_rules(orders, [Rule("cust", "consistentStringFormatPreserving", rule)], fx.context())
    right = apply_rules(customers, [Rule("client", "consistentStringFormatPreserving", rule)], fx.context())
    return left.join(right, F.col("cust") == F.col("client")).groupBy("c_mktsegment").agg(F.sum("n").alias("n"))


QUERIES["mask_id_join"] = mask_id_join
ORACLES["mask_id_join"] = "SELECT c_mktsegment, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
over_pii("mask_permute_nulls", "birth", "keepDistribution", None, statement=permuted("birth", "pii", ROW))
over_pii("mask_sha1", "label", "hashWithSha1", f"sha1({label})")
over_pii("mask_sha1_salt", "label", "hashWithSha1", f"sha1('pepper' || {label})", {"salt": "pepper"})
over_table("mask_sha256", "documents", ("doc_id",), "text", "hashWithSha256",
           f"SELECT doc_id, sha256({words('text')}) AS text FROM documents")
over_pii("mask_sha256_salt", "label", "hashWithSha256", f"sha256('pepper' || {label})", {"salt": "pepper"})


def fpe_num_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys as numbers, card numbers as texts: encrypted, then decrypted."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("value"))
    closed = apply_rules(orders, [Rule("value", "consistentNumericFormatPreserving")], fx.context())
    opened = apply_rules(
        closed.withColumn("length_kept", F.length(F.col("value").cast("string")) == F.length(F.col("o_orderkey").cast("string"))),
        [Rule("value", "consistentNumericFormatPreservingDecryption")], fx.context())
    return opened


def fpe_num_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By digit count: all ciphers differ from each other, and most from their number where there are enough numbers."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("value"))
    closed = apply_rules(orders, [Rule("value", "consistentNumericFormatPreserving")], fx.context())
    return closed.groupBy(F.length(F.col("o_orderkey").cast("string")).alias("digits")).agg(
        F.count_distinct("value").alias("ciphers"),
        ((F.avg((F.col("value") != F.col("o_orderkey")).cast("int")) > 0.9) | (F.count("*") < 100)).alias("changed"))


def fpe_str_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents: encrypted, then decrypted; ``changed`` where the text in between was another one."""
    docs = spread(fx.table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("value", F.col("text"))
    closed = apply_rules(docs, [Rule("value", "consistentStringFormatPreserving")], fx.context())
    marked = closed.withColumns({
        "length_kept": F.length("value") == F.length("text"),
        # A text of few letters may be its own cipher; one of twenty practically never.
        "changed": (F.col("value") != F.col("text")) | (F.length("text") < 20)})
    opened = apply_rules(marked, [Rule("value", "consistentStringFormatPreservingDecryption")], fx.context())
    return opened.select("doc_id", "value", "length_kept", "changed")


def fpe_num_cipher(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").cast("bigint").alias("value"))
    return apply_rules(orders, [Rule("value", "consistentNumericFormatPreserving")], fx.context())


def cipher_duck() -> str:
    """Ten rounds as ten subqueries, on the rectangle of each digit count."""
    low, n1, n2 = (
        "[" + ", ".join(str(10**d if k == 0 and d else 0 if k == 0 else (9 * 10 ** (d // 2), 10 ** (d - d // 2))[k - 1]
                            if d else (1, 10)[k - 1]) for d in range(18)) + "][place]"
        for k in range(3)
    )
    sql = f"""SELECT o_orderkey, {low} AS low, {n1} AS n1, {n2} AS n2, (o_orderkey - {low}) // {n2} AS a,
        (o_orderkey - {low}) % {n2} AS b, concat_ws('|', sha256('{fx.CHECK_KEY}|value'), '1', place) AS label
      FROM (SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, length(CAST(o_orderkey AS VARCHAR)) AS place FROM orders) AS o"""
    for i in range(10):
        h, cells = f"sha256(concat_ws('|', label, '{i}', b))", ("n1", "n2")[i % 2]
        sql = f"SELECT o_orderkey, low, n1, n2, b AS a, (a + {number(h, 1, 15)} % {cells}) % {cells} AS b, label FROM ({sql}) AS r{i}"
    return f"SELECT o_orderkey, a * n2 + b + low AS value FROM ({sql}) AS done"


def fpe_str_cipher(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spread(fx.table(spark, sf_dir, "customer").select("c_custkey", F.translate("c_name", "#", "é").alias("value")))
    return apply_rules(names, [Rule("value", "consistentStringFormatPreserving")], fx.context())


def text_cipher_duck() -> str:
    """Ten rounds as ten subqueries over lists of ranks; all characters of the names are in the alphabet."""
    alphabet = TEXT_ALPHABET.replace("'", "''")
    size, key = len(TEXT_ALPHABET), f"sha256('{fx.CHECK_KEY}|value')"
    sql = f"""SELECT c_custkey, len(r) AS n, r[1:len(r) // 2] AS a, r[len(r) // 2 + 1:] AS b FROM (
        SELECT c_custkey, list_transform({chars_of("replace(c_name, '#', 'é')")}, lambda c: CAST(instr('{alphabet}', c) - 1 AS BIGINT)) AS r FROM customer) AS c"""
    for i in range(10):
        own, other = ("a", "b") if i % 2 == 0 else ("b", "a")
        # Of twelve numbers from each hash, the one for place j.
        slices = f"CAST('0x' || substr(sha256(concat_ws('|', seed, (j - 1) // 12)), CAST((j - 1) % 12 // 3 * 15 + 1 AS INT), 15) AS BIGINT)"
        number_of = f"({slices} >> CAST((j - 1) % 3 * 20 AS INT)) % 1048576"
        moved = f"list_transform(range(1, len({own}) + 1), lambda j: ({own}[j] + {number_of}) % {size})"
        sql = f"""SELECT c_custkey, n, {moved} AS {own}, {other} FROM (
          SELECT *, sha256(concat_ws('|', {key}, n, '{i}', CAST({other} AS VARCHAR))) AS seed FROM ({sql}) AS q{i}) AS s{i}"""
    letters = f"list_transform(list_concat(a, b), lambda x: substr('{alphabet}', CAST(x + 1 AS INT), 1))"
    return f"SELECT c_custkey, array_to_string({letters}, '') AS value FROM ({sql}) AS done"


QUERIES["fpe_str_cipher"], ORACLES["fpe_str_cipher"] = fpe_str_cipher, text_cipher_duck()
QUERIES["fpe_num_cipher"], ORACLES["fpe_num_cipher"] = fpe_num_cipher, cipher_duck()
QUERIES["fpe_num_roundtrip"] = fpe_num_roundtrip
ORACLES["fpe_num_roundtrip"] = "SELECT o_orderkey, o_orderkey AS value, TRUE AS length_kept FROM orders"
QUERIES["fpe_num_changed"] = fpe_num_changed
ORACLES["fpe_num_changed"] = (
    "SELECT length(CAST(o_orderkey AS VARCHAR)) AS digits, count(*) AS ciphers, TRUE AS changed FROM orders GROUP BY ALL"
)
QUERIES["fpe_str_roundtrip"] = fpe_str_roundtrip
ORACLES["fpe_str_roundtrip"] = (
    f"SELECT doc_id, {words('text')} AS value, CASE WHEN {words('text')} IS NULL THEN NULL ELSE TRUE END AS length_kept, "
    f"CASE WHEN {words('text')} IS NULL THEN NULL ELSE TRUE END AS changed FROM documents"
)

TABLE_RULES = [
    Rule("label", "id"),
    Rule("iban", "hashWithSha256"),
    Rule("card", "card"),
    Rule("email", "email"),
    Rule("tel", "tel"),
    Rule("name", "lastname"),
    Rule("amount_int", "randomInts", {"int_bounds": "[0;1000]"}),
    Rule("amount_long", "blank", {"respect_type": "true"}),
    Rule("birth", "randomDates"),
    Rule("optin", "randomBooleans"),
]


def mask_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(fx.pii(spark, sf_dir), TABLE_RULES, fx.context(ROW))


def _expression(name: str, column: str) -> str:
    """The select expression of a single-column oracle."""
    text = ORACLES[name]
    return text[text.rindex(f"SELECT {ROW}, ") + len(f"SELECT {ROW}, ") : text.rindex(f" AS {column} FROM")]


QUERIES["mask_table"] = mask_table
ORACLES["mask_table"] = f"""
WITH pii AS MATERIALIZED ({fx.PII_DUCK}),
s AS MATERIALIZED (SELECT *, {seed('label', label)} AS s, {chars_of('label')} AS a FROM pii),
d AS MATERIALIZED (SELECT *, {streams('a', 's')} FROM s)
SELECT c_custkey, {unless_null(label, substituted('a'))} AS label, sha256(iban) AS iban,
  {_expression('mask_card', 'card')} AS card, {_expression('mask_email', 'email')} AS email,
  {_expression('mask_tel', 'tel')} AS tel, {_expression('mask_lastname', 'name')} AS name,
  {unless_null('amount_int', f"CAST({number(row['amount_int'], 1, 15)} % 1000 AS INT)")} AS amount_int,
  CAST(0 AS BIGINT) AS amount_long, amount_double, {_expression('mask_date', 'birth')} AS birth,
  {_expression('mask_bool', 'optin')} AS optin
FROM d"""


def null_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lethe.functions.text import null_words as as_null

    return fx.pii(spark, sf_dir).select(ROW, as_null(F.col("label")).alias("label"))


QUERIES["null_words"] = null_words
ORACLES["null_words"] = f"WITH pii AS ({fx.PII_DUCK}) SELECT {ROW}, {words('label')} AS label FROM pii"
