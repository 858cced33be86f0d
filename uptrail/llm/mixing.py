"""Mixing sources to target weights: budgets down a tree, then a token prefix of each leaf."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window, functions as F

from uptrail.llm.common import written

BIG = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """weights: for each level, the weight of a value; paths: the weight of one node, by its path from
    the root. Others have weight 1; a node of weight 0 gets nothing. share: the tokens wanted, as
    (part, of) of all tokens there are; budget: as a number instead. epochs: how often a document
    may be taken at most."""
    weights: tuple[dict[str | None, int], ...] = ()
    paths: dict[tuple[str | None, ...], int] = field(default_factory=dict)
    share: tuple[int, int] = (1, 1)
    budget: int | None = None
    epochs: int = 1
    seed: int = 0


def escaped(value: str | None) -> str:
    return "-" if value is None else "=" + value.replace("/", "//")


def path_of(columns: list[F.Column]) -> F.Column:
    """A text for the values, null apart from all values."""
    parts = [F.coalesce(F.concat(F.lit("="), F.replace(c.cast("string"), F.lit("/"), F.lit("//"))), F.lit("-")) for c in columns]
    return F.concat_ws("/", *parts)


def looked_up(key: F.Column, table: dict[str, int]) -> F.Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key).cast("long") if pairs else F.lit(None).cast("long")


def weight_of(mix: Mix, level: int) -> F.Column:
    """Of a node with the path in _p{level}."""
    by_path = {"/".join(map(escaped, p)): w for p, w in mix.paths.items() if len(p) == level}
    by_value = {escaped(v): w for v, w in mix.weights[level - 1].items()} if level <= len(mix.weights) else {}
    return F.coalesce(looked_up(F.col(f"_p{level}"), by_path), looked_up(F.col(f"_v{level}"), by_value), F.lit(1))


def budgets(leaves: DataFrame, levels: int, mix: Mix) -> DataFrame:
    """The budget of each leaf. leaves: _p1.._pn, _v1.._vn, docs, tokens.

    A node can use what its children of positive weight can. From the root down, the children of a
    node share its budget by weight; a child that can use less than its share gets what it can use,
    and the rest is shared among its siblings in the same way. So a shortage leaves a node only if
    all its children are used up. Shares are whole numbers that add up to the node's budget.

    One row for each node, so windows here see the children of a node, not documents.
    """
    up = {levels: leaves.withColumn("can", F.col("tokens") * mix.epochs)}
    for k in range(levels, 0, -1):
        up[k] = up[k].withColumn("weight", weight_of(mix, k)).withColumn(
            "can", F.when(F.col("weight") > 0, F.col("can")).otherwise(0))
        if k > 1:
            keys = [c for i in range(1, k) for c in (f"_p{i}", f"_v{i}")]
            up[k - 1] = up[k].groupBy(*keys).agg(F.sum("can").alias("can"))
    if (whole := mix.budget) is None:  # one number
        whole = int(leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]) * mix.share[0] // mix.share[1]
    top = None
    for k in range(1, levels + 1):
        nodes = up[k].where("weight > 0 AND can > 0")
        nodes = nodes.withColumns({"_p0": F.lit(""), "_budget": F.lit(whole).cast("long")}) if k == 1 else nodes.join(top, f"_p{k - 1}")
        own, order = Window.partitionBy(f"_p{k - 1}"), [F.col("can") / F.col("weight"), f"_p{k}"]
        past = own.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        rest = own.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
        big = lambda c: F.col(c).cast(BIG)
        nodes = nodes.withColumn("used", F.coalesce(F.sum(big("can")).over(past), F.lit(0)).cast(BIG))
        nodes = nodes.withColumn("left", F.sum("weight").over(rest))
        full = big("can") * big("left") <= (big("_budget") - F.col("used")) * big("weight")
        nodes = nodes.withColumn("full", full)
        nodes = nodes.withColumns({
            "given": F.coalesce(F.sum(F.when(F.col("full"), big("can"))).over(own), F.lit(0)).cast(BIG),
            "open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(own), F.lit(1)).cast(BIG),
            "to": F.sum(F.when(~F.col("full"), F.col("weight"))).over(own.orderBy(f"_p{k}").rowsBetween(Window.unboundedPreceding, 0))})
        part = lambda w: F.floor((F.col("_budget") - F.col("given")).cast(BIG) * w.cast(BIG) / F.col("open"))
        fair = part(F.col("to")) - part(F.col("to") - F.col("weight"))
        nodes = nodes.withColumn("_b", F.when(F.col("full"), F.col("can")).otherwise(fair).cast("long"))
        top = nodes.select(f"_p{k}", F.col("_b").alias("_budget"))
    return top.join(leaves, f"_p{levels}").select(
        F.col(f"_p{levels}").alias("_leaf"), "docs", "tokens", F.col("_budget").alias("budget"))


def place_in_epoch(mix: Mix, epoch: F.Column, key: F.Column) -> F.Column:
    return F.md5(F.concat_ws(":", F.lit(str(mix.seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("-"))))


def content(docs: DataFrame) -> F.Column:
    """128 bits of a row, as a text; rows that are equal have the same."""
    plain = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in docs.schema]
    # a null leaves a hash as it was, so where the nulls are counts too
    parts = [*plain, F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in docs.columns])]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), *parts)), 16, "0") for i in range(2)])


def reached(parts: DataFrame, spot: list[str], name: str) -> DataFrame:
    """For each leaf where its prefix of `rest` tokens ends, in the order of spot: _cut, _before (the
    tokens that come before), _many (rows there), _row (the smallest content there).

    The first of spot is a hash as a hexadecimal text. It cuts a leaf's rows into `bins` bins; the
    sums of the bins give that in which the prefix ends, and only its rows are put in order.
    """
    bin_of = F.floor(F.conv(F.substring(spot[0], 1, 8), 16, 10).cast("long") * F.col("bins") / (1 << 32)).cast("long")
    parts = parts.withColumn("_bin", bin_of)
    sums = parts.groupBy("_leaf", "rest", "_bin").agg(F.sum("_n").alias("_sum"))
    past = Window.partitionBy("_leaf").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_past", F.coalesce(F.sum("_sum").over(past), F.lit(0)))
    last = written(sums.where("_past < rest AND _past + _sum >= rest").select(
        F.col("_leaf").alias("_l"), F.col("_bin").alias("_b"), "_past"), f"mix-{name}")
    edge = parts.join(last, (F.col("_leaf") == F.col("_l")) & (F.col("_bin") == F.col("_b")))
    edge = edge.groupBy("_leaf", "_past", "rest", F.struct(*spot).alias("_spot")).agg(
        F.sum("_n").alias("_n"), F.count("*").alias("_many"), F.min("_row").alias("_row"))
    inside = Window.partitionBy("_leaf").orderBy("_spot").rowsBetween(Window.unboundedPreceding, -1)
    edge = edge.withColumn("_before", F.col("_past") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return edge.where("_before < rest").groupBy("_leaf").agg(
        F.max("_spot").alias("_cut"), *[F.max_by(c, "_spot").alias(c) for c in ("_before", "_many", "_row")])


def plan(docs: DataFrame, levels: list[F.Column], key: str, tokens: F.Column, mix: Mix) -> DataFrame:
    """For each leaf: budget, whole epochs, and where in the order of the next epoch its prefix ends.

    _cut: the last place (hash, key) and row (content) that the prefix reaches, null if it takes none; _before: the
    tokens that come before; _many: the equal rows there. A leaf's documents are cut by their hash into about sqrt(n)
    bins of about sqrt(n) documents, and rows that share the key at the cut by their content in the
    same way. No leaf and no key is brought together in one task.
    """
    k = len(levels)
    named = {f"_v{i + 1}": path_of([c]) for i, c in enumerate(levels)} | {
        f"_p{i + 1}": path_of(levels[:i + 1]) for i in range(k)}
    rows = docs.select(*[c.alias(n) for n, c in named.items()], F.col(key).alias("_key"), tokens.alias("_n"), content(docs).alias("_row"))
    rows = written(rows, "mix-rows")
    leaves = written(rows.groupBy(*named).agg(F.count("*").alias("docs"), F.sum("_n").alias("tokens")), "mix-leaves")
    wanted = budgets(leaves, k, mix).withColumns({
        "epochs": F.when(F.col("tokens") > 0, F.expr("budget DIV tokens")).otherwise(0).cast("long"),
        "bins": F.ceil(F.sqrt("docs")).cast("long")}).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    wanted = written(wanted, "mix-budgets")
    parts = rows.join(wanted.where("rest > 0"), rows[f"_p{k}"] == wanted["_leaf"]).select(
        "_leaf", "_n", "_row", "bins", "rest", place_in_epoch(mix, F.col("epochs"), F.col("_key")).alias("_place"),
        F.coalesce(F.col("_key").cast("string"), F.lit("")).alias("_k"))
    ends = written(reached(parts, ["_place", "_k"], "bins"), "mix-ends")
    shared = ends.where("_many > 1").select(F.col("_leaf").alias("_s"), F.col("_cut").alias("_at"), F.col("_before").alias("_first"), F.col("_many").alias("_all"))
    tied = parts.join(shared, (F.col("_leaf") == F.col("_s")) & (F.struct("_place", "_k") == F.col("_at"))).select(
        "_leaf", "_n", "_row", (F.col("rest") - F.col("_first")).alias("rest"), F.ceil(F.sqrt("_all")).cast("long").alias("bins"))
    inner = reached(tied, ["_row"], "tied").select(F.col("_leaf").alias("_i"), F.col("_cut._row").alias("_ir"), F.col("_before").alias("_ib"), F.col("_many").alias("_im"))
    ends = ends.join(inner, F.col("_leaf") == F.col("_i"), "left").select(
        "_leaf", F.when(F.col("_cut").isNotNull(), F.struct("_cut._place", "_cut._k", F.coalesce("_ir", "_row").alias("_row"))).alias("_cut"),
        (F.col("_before") + F.coalesce("_ib", F.lit(0))).alias("_before"), F.coalesce("_im", F.lit(1)).cast("long").alias("_many"))
    return written(wanted.join(ends, "_leaf", "left"), "mix-plan")


#: Equal rows at a cut are numbered in chunks of so many.
CHUNK = 4096


def numbered(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with _mix_i. Equal rows at the cut of a leaf are numbered from 0, all others have 0."""
    at_cut = F.col("_mix_end") & (F.col("_mix_many") > 1)
    one = rows.where(~at_cut).withColumn("_mix_i", F.lit(0).cast("long"))
    many = rows.where(at_cut).groupBy("_mix_leaf").agg(F.first(F.struct(*columns)).alias("_mix_r"), F.count("*").alias("_mix_c"))
    last = F.floor((F.col("_mix_c") - 1) / CHUNK).cast("long")
    many = many.withColumn("_mix_k", F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition("_mix_leaf", "_mix_k")
    end = F.least(F.col("_mix_c"), (F.col("_mix_k") + 1) * CHUNK) - 1
    many = many.withColumn("_mix_i", F.explode(F.sequence(F.col("_mix_k") * CHUNK, end)))
    return one.select(*columns, "_mix_i").union(many.select(*[F.col("_mix_r")[c].alias(c) for c in columns], "_mix_i"))


def mixed(docs: DataFrame, levels: list[F.Column], key: str = "doc_id", tokens: F.Column | None = None, mix: Mix = Mix()) -> DataFrame:
    """The documents taken, with budget (of the leaf), copies and tokens_taken; columns of these
    names are replaced.

    levels: from the root down, for instance domain, language, source. A leaf is taken whole as
    many epochs as its budget holds; then a prefix of the next epoch, in an order given by seed,
    epoch and key. copies counts the epochs a document is in, with the last begun one.
    tokens_taken adds up to the budget of the leaf: of the document where the prefix ends, only the
    first tokens count.

    A null level is a group of its own. A null text or one without tokens counts 0 and is taken
    where its place comes. Rows that repeat a key stand side by side, in an order given by their
    content; of equal rows at the end of the prefix, as many are taken as it reaches. Empty tables give no rows.
    """
    n = F.coalesce(tokens, F.lit(0)).cast("long")
    taken = plan(docs, levels, key, n, mix)
    named = docs.drop("budget", "copies", "tokens_taken")
    mine = lambda c: F.col(f"_mix_{c}")
    rows = docs.withColumns({"_mix_leaf": path_of(levels), "_mix_n": n, "_mix_row": content(docs)})
    tied = not taken.where("_many > 1").isEmpty()
    taken = taken.select(*[F.col(c).alias(f"_mix_{new}") for c, new in (
        ("_leaf", "l"), ("budget", "budget"), ("epochs", "epochs"), ("rest", "rest"), ("_cut", "cut"), ("_before", "before"), ("_many", "many"))])
    rows = rows.join(taken, mine("leaf") == mine("l"))
    spot = F.struct(place_in_epoch(mix, mine("epochs"), F.col(key)).alias("_place"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"),
                    mine("row").alias("_row"))
    rows = rows.withColumns({"_mix_in": F.coalesce(spot <= mine("cut"), F.lit(False)), "_mix_end": F.coalesce(spot == mine("cut"), F.lit(False))})
    columns = [*named.columns, *(f"_mix_{c}" for c in ("budget", "epochs", "n", "rest", "before", "in", "end"))]
    rows = numbered(rows, columns) if tied else rows.select(*columns, F.lit(0).cast("long").alias("_mix_i"))
    left = mine("rest") - mine("before") - mine("i") * mine("n")
    inside = mine("in") & (~mine("end") | (left > 0))
    part = F.when(inside & mine("end"), F.least(mine("n"), left)).when(inside, mine("n")).otherwise(0)
    copies = mine("epochs") + inside.cast("long")
    return rows.where(copies > 0).select(*named.columns, mine("budget").alias("budget"), copies.alias("copies"),
                                         (mine("epochs") * mine("n") + part).alias("tokens_taken"))
