"""URL filtering by fixed host and path rules, else by association rules mined from labels.

A labelled URL becomes the set of its tokens (scheme, host labels, path segments with digits as
"0", extension, query keys, fragment) and, if its label is bad, the item ``block``. Tokens that too few
URLs have can't be in a frequent combination and are left out; tokens that occur in exactly the same URLs
(a template's fixed parts) count as one item, so long templates don't multiply their combinations.
FP-growth finds the frequent combinations of any length. One that implies ``block`` becomes a rule if the
lower confidence bound of its bad share (Wilson's, at ``Z``) reaches ``MIN_LIFT`` times the share of bad among all
labelled URLs; rules that a part of them implies as surely go. Each rule is listed in an inverted
index under its rarest token, so a URL meets only rules that share it, and is blocked when it has all their tokens.

Everything runs on DataFrame and library functions; joins are left to the optimizer, which sees their size.

Definitions: a null URL or one without "://" has empty host and path, and no tokens. A fixed rule holds for
its host and all subdomains where the path starts with its path; the longest wins, then the earlier
one. Without any rule a URL is allowed. Labels of one id count once, bad if any says so.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneloom.llm.common import numbered
from paneloom.session import materialise

BLOCK = "block"
MIN_SUPPORT = 0.002  # of the labelled URLs
MIN_ROWS = 10  # labelled URLs that a rule rests on, at least
MIN_LIFT = 2.0  # of a rule's bad share, by its lower bound, over the share of all
Z = 1.96  # standard errors below the bad share at which that bound lies
# Action, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def tokens(url: Column) -> Column:
    """The different tokens of a URL, in order."""
    text = F.coalesce(url, F.lit(""))
    scheme = F.translate(F.regexp_extract(text, "(?s)^([^:/?#]*)://", 1), _UPPER, _LOWER)
    plain = F.regexp_replace(path(url), "[0-9]+", "0")
    query = F.regexp_extract(text, "(?s)^[^?#]*\\?([^#]*)", 1)

    def tagged(tag, values):
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(tag), x))

    all_tokens = F.concat(
        tagged("scheme:", F.array(scheme)),
        tagged("host:", F.split(host(url), "\\.")),
        tagged("path:", F.split(plain, "/")),
        tagged("type:", F.array(F.regexp_extract(plain, "\\.([A-Za-z0-9]{1,5})$", 1))),
        tagged("key:", F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))),
        F.when(text.contains("#"), F.array(F.lit("fragment"))).otherwise(
            F.array().cast("array<string>")
        ),
    )
    return F.when(text.contains("://"), F.array_distinct(all_tokens)).otherwise(
        F.array().cast("array<string>")
    )


def fixed_rule(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest rule that holds, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for action, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        holds = ((host_col == name) | host_col.endswith(f".{name}")) & path_col.startswith(start)
        own = F.struct(F.lit(name + start).alias("rule"), F.lit(action).alias("verdict"))
        found = F.when(holds, own).otherwise(found)
    return found


_RULE_FIELDS = "rule_id long, tokens array<string>, confidence double, support double, token string"


def _items(baskets: DataFrame, least: int) -> DataFrame:
    """Tokens of at least ``least`` baskets (own, tokens) as (token, item, members, freq).

    Tokens of the same baskets share the item: their count and two sums of basket hashes are equal.
    """
    single = baskets.select("own", F.explode("tokens").alias("token"))
    bits = F.xxhash64("own")
    marks = (
        single.groupBy("token")
        .agg(
            F.count("*").alias("freq"),
            F.bit_xor(bits).alias("mark"),
            F.sum(F.shiftright(bits, 20)).alias("total"),
        )
        .where(F.col("freq") >= least)
    )
    classes = marks.groupBy("freq", "mark", "total").agg(F.array_sort(F.collect_list("token")).alias("members"))
    return classes.select(
        F.explode("members").alias("token"), F.col("members")[0].alias("item"), "members", "freq"
    )


def lower_bound(share: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of a share seen in ``n`` cases."""
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - spread) / (1 + z * z / n)


def mine(
    urls: DataFrame,
    labels: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_lift: float = MIN_LIFT,
    min_rows: int = MIN_ROWS,
    z: float = Z,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
    label: Column | None = None,
) -> DataFrame:
    """Rules that block: rule_id, tokens, confidence, support, and the token that indexes them.

    ``label`` (default: quality = 0) says which rows of ``labels`` are bad; null is no label.
    """
    bad = F.col("quality") == 0 if label is None else label
    known = (
        labels.select(F.col(label_id).alias("labelled"), bad.alias("bad"))
        .where("labelled is not null and bad is not null")
        .groupBy("labelled")
        .agg(F.max("bad").alias("bad"))
    )
    baskets = numbered(
        urls.select(F.col(id_col).alias("page"), tokens(F.col(url_col)).alias("tokens"))
        .join(known, F.col("page") == F.col("labelled"))
        .where(F.size("tokens") > 0)
        .select("tokens", "bad"),
        "own",
    )
    spark = urls.sparkSession
    rows, bads = baskets.agg(F.count("*"), F.count_if("bad")).first()
    if not bads:
        return spark.createDataFrame([], T.StructType.fromDDL(_RULE_FIELDS))
    least = max(min_rows, math.ceil(min_support * rows))
    items = materialise(_items(baskets, least))
    listed = (
        baskets.select("own", F.explode("tokens").alias("token"))
        .join(items.where("token = item"), "token")
        .groupBy("own")
        .agg(F.collect_list("item").alias("items"))
    )
    none = F.array().cast("array<string>")
    seen = materialise(
        baskets.join(listed, "own", "left").select(
            F.concat(
                F.coalesce("items", none), F.when(F.col("bad"), F.array(F.lit(BLOCK))).otherwise(none)
            ).alias("items")
        )
    )
    base = bads / rows
    model = FPGrowth(
        itemsCol="items", minSupport=min(1.0, least / rows), minConfidence=min(1.0, min_lift * base)
    ).fit(seen)
    found = F.col("support") * rows / F.col("confidence")  # URLs that have the tokens
    members = items.where("token = item").select("item", "members", "freq")
    mined = numbered(
        model.associationRules.where(F.col("consequent")[0] == BLOCK)
        .where(lower_bound(F.col("confidence"), found, z) >= min_lift * base)
        .select("antecedent", "confidence", "support"),
        "rule_id",
    )
    whole = (
        mined.select("*", F.explode("antecedent").alias("item"))
        .join(members, "item")
        .groupBy("rule_id", "confidence", "support")
        .agg(
            F.array_sort(F.flatten(F.collect_list("members"))).alias("tokens"),
            F.min(F.struct("freq", "item"))["item"].alias("token"),
        )
    )
    whole = materialise(whole.select("rule_id", "tokens", "confidence", "support", "token"))
    # a rule is needless where another one's tokens are among its own and imply as much
    part = whole.select(F.col("tokens").alias("fewer"), F.col("confidence").alias("as_sure"), "token")
    needless = (
        whole.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("token"))
        .join(part, "token")
        .where("as_sure >= confidence and size(fewer) < size(tokens) and size(array_except(fewer, tokens)) = 0")
        .select("rule_id")
    )
    return whole.join(needless, "rule_id", "left_anti")


def judge(
    urls: DataFrame,
    mined: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per row of ``urls``: page_id, host, path, rule, verdict, mined_tokens, confidence."""
    rows = numbered(
        urls.select(
            F.col(id_col).alias("page_id"),
            host(F.col(url_col)).alias("host"),
            path(F.col(url_col)).alias("path"),
            tokens(F.col(url_col)).alias("tokens"),
        )
    )
    open_rows = rows.where(fixed_rule(F.col("host"), F.col("path"), rules).isNull())
    met = (
        open_rows.select(
            "row_key", F.col("tokens").alias("own"), F.explode("tokens").alias("token")
        )
        .join(mined, "token")
        .where(F.size(F.array_except("tokens", "own")) == 0)
        .groupBy("row_key")
        .agg(F.max(F.struct("confidence", "support", "tokens")).alias("best"))
    )
    fixed = fixed_rule(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        rows.join(met, "row_key", "left")
        .withColumn("fixed", fixed)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fixed.rule").alias("rule"),
            F.coalesce(F.col("fixed.verdict"), learnt).alias("verdict"),
            F.array_join("best.tokens", " ").alias("mined_tokens"),
            F.col("best.confidence").alias("confidence"),
        )
    )
