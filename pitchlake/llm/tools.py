"""Tool-call linking for chat records, in DataFrame functions only.

Calls and results are joined by identifier (a hash join of one row per
identifier and side).  Arguments are parsed to variants,
whose text form is canonical (sorted keys, no spaces), and checked against a
schema for each tool.  Calls are put in a stable topological order: a call
keeps its own turn as key unless something it depends on comes later, in which
case it moves to just after that.  Only conversations with references forward
need any work for that; no conversation is gathered in one task unless its
references are few (``SMALL``), and longer ones are ordered by joins, in
rounds that grow with the logarithm of a chain.

Identifiers repeated within a conversation: the first call (least turn, then
tool, arguments and dependencies) and the
first result (least turn, then text) count; further ones are kept with status
``repeated call`` or ``repeated result``, without an order.  Null identifiers link with nothing
(``unanswered``, ``orphan``).  Null or unparsable arguments are invalid.
References to calls that don't exist are errors of the call, without effect on
the order.  Calls in a cycle, and those that depend on one, get a null order.
Very long texts and arguments are kept whole.  An empty table gives
an empty result; columns beyond those named are ignored.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import forget, looked_up, shared_dir, written

#: tool -> field -> (type, required)
SCHEMAS = {"reply": {"after": ("string", False), "text": ("string", True), "turn": ("integer", True)}}
#: What schema_of_variant calls the JSON types.
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",)}


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results a plain conversation stands for.

    Each user turn calls ``reply`` with its text.  One of several lines goes on
    from the user turn two before, where there can be one; one of a single line
    waits for the user turn two after it, whether or not there is one.  Without
    a comma its turn is given as text, which the schema doesn't allow.  A system
    turn is a call of ``configure``, which no schema knows, with bare text as arguments, under
    the identifier of the turn after it.

    An assistant turn is the result of the turn before it if it has a comma and several lines; without a
    comma it is one more result of the turn three before, else it answers the turn after it ahead of time.
    """
    c = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    turn, many, comma = F.col("turn"), F.contains("text", F.lit("\n")), F.contains("text", F.lit(","))
    name = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    after = F.when(many & (turn >= 2), name(turn - 2)).when(~many, name(turn + 2))
    told = F.when(comma, F.to_json(F.struct("turn", "text", after.alias("after")))).otherwise(F.to_json(F.struct(turn.cast("string").alias("turn"), "text", after.alias("after"))))
    none = F.array().cast("array<string>")
    user = c.filter("role = 'user'").select("conv_id", "turn", name(turn).alias("call_id"), F.lit("reply").alias("tool"), told.alias("arguments"), F.when(after.isNotNull(), F.array(after)).otherwise(none).alias("depends"))
    system = c.filter("role = 'system'").select("conv_id", "turn", name(turn + 1).alias("call_id"), F.lit("configure").alias("tool"), F.col("text").alias("arguments"), none.alias("depends"))
    answered = F.when(~comma, turn - 3).when(many, turn - 1).otherwise(turn + 1)
    results = c.filter("role = 'assistant'").select("conv_id", "turn", name(answered).alias("call_id"), F.col("text").alias("content"))
    return user.unionByName(system), results


def argument_errors(tool: Column, args: Column, schemas: dict) -> Column:
    """What is wrong with parsed arguments (a variant), as an array of texts."""
    known = reduce(lambda a, b: a | b, [tool == t for t in schemas], F.lit(False))
    out = [F.when(args.isNull(), F.lit("not JSON")), F.when(~F.coalesce(known, F.lit(False)), F.lit("unknown tool")), F.when(args.isNotNull() & ~F.startswith(F.schema_of_variant(args), F.lit("OBJECT")), F.lit("not an object"))]
    for name, fields in schemas.items():
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_variant_get(args, f"$.{field}", "variant")
            found = F.schema_of_variant(value)
            right = reduce(lambda a, b: a | b, [F.startswith(found, F.lit(t)) for t in TYPES[kind]])
            absent = value.isNull() | (found == "VOID")
            own = (tool == name) & args.isNotNull()
            if required:
                out.append(F.when(own & absent, F.lit(f"missing {field}")))
            out.append(F.when(own & ~absent & ~right, F.lit(f"{field} is no {kind}")))
    return F.filter(F.array(*out), lambda e: e.isNotNull())


KEY = ["conv_id", "call_id"]
#: References of a conversation that one expression orders; larger ones are ordered by joins, with the same result.
SMALL = 2000


def _ordered_small(links: DataFrame) -> DataFrame:
    """``conv_id, call_id, t, d`` of every call with a reference, null behind cycles; each conversation is one bounded row.

    Round by round, a call gets its key once all calls it refers to have theirs.
    """
    one = links.groupBy(*KEY).agg(F.min("turn").cast("long").alias("turn"), F.collect_list(F.struct("dep", F.col("dep_turn").cast("long").alias("t"))).alias("deps"))
    own = one.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("call_id", "turn", "deps"))).alias("calls"))
    own = own.withColumn("names", F.col("calls.call_id"))
    # a place of 0: a call without references, whose key is its turn
    place = lambda c: F.transform(c["deps"], lambda d: F.struct(F.array_position("names", d["dep"]).cast("int").alias("i"), d["t"].alias("t")))
    own = own.withColumn("refs", F.transform("calls", lambda c: F.struct(c["turn"].alias("turn"), place(c).alias("deps"))))
    key = lambda t, d: F.struct(t.cast("long").alias("t"), d.cast("int").alias("d"))
    nothing = F.lit(None).cast("struct<t: bigint, d: int>")

    def step(acc: Column, _: Column) -> Column:
        found = acc["found"]
        at = lambda d: F.when(d["i"] == 0, key(d["t"], F.lit(0))).otherwise(F.get(found, d["i"] - 1))

        def call(ref: Column, i: Column) -> Column:
            top = F.array_max(F.transform(ref["deps"], at))
            new = F.when(top["t"] >= ref["turn"], key(top["t"], top["d"] + 1)).otherwise(key(ref["turn"], F.lit(0)))
            return F.when(F.get(found, i).isNotNull(), F.get(found, i)).when(F.exists(ref["deps"], lambda d: at(d).isNull()), nothing).otherwise(new)

        now = F.transform("refs", call)
        return F.when(acc["done"], acc).otherwise(F.struct(now.alias("found"), (now == found).alias("done")))

    begin = F.struct(F.transform("refs", lambda _: nothing).alias("found"), F.lit(False).alias("done"))
    solved = own.withColumn("found", F.aggregate(F.sequence(F.lit(1), F.size("refs")), begin, step)["found"])
    flat = solved.select("conv_id", F.explode(F.arrays_zip("names", "found")).alias("x"))
    return flat.select("conv_id", F.col("x.names").alias("call_id"), F.col("x.found.t").alias("t"), F.col("x.found.d").alias("d"))


def _met(nodes: DataFrame, jump: bool) -> DataFrame:
    """``nodes`` with open references after each has met what it refers to: known keys are taken over, with ``jump`` lone references are followed.

    A call's key is the greatest of its own turn and, for each reference, the key referred to, one deeper (lexicographically).  So a
    call that refers to one with a single reference left may refer to that one's target instead, as much deeper as the way is long.
    What can't get a key falls out: calls that refer to themselves, by a way longer than the conversation has references, or to calls that fell out.
    """
    lone = F.get("deps", F.lit(0))
    states = nodes.select("conv_id", F.col("call_id").alias("dep"), F.size("deps").alias("m"), F.col("k").alias("dk"), lone["dep"].alias("to"), lone["w"].alias("tw"))
    edges = nodes.filter(F.size("deps") > 0).select(*KEY, "n", "k", F.explode("deps").alias("e")).select(*KEY, "n", "k", "e.dep", "e.w")
    met = looked_up(edges, ["conv_id", "dep"], states)
    known, follows = F.col("m") == 0, (F.col("m") == 1) & F.lit(jump)
    gained = F.when(known | follows, F.struct(F.col("dk.t").alias("t"), (F.col("dk.d") + F.col("w")).alias("d")))
    left = F.when(follows, F.struct(F.col("to").alias("dep"), (F.col("w") + F.col("tw")).alias("w"))).when(~known, F.struct("dep", "w"))
    told = met.groupBy(*KEY).agg(F.first("n").alias("n"), F.greatest(F.first("k"), F.max(gained)).alias("k"), F.array_sort(F.collect_list(left)).alias("all"), F.bool_or(F.col("m").isNull()).alias("lost"), F.bool_or(known | follows).alias("changed"))
    # of several ways to one call the longest counts
    last = lambda x, i: F.coalesce(F.get("all", i + 1)["dep"] != x["dep"], F.lit(True))
    told = told.withColumn("deps", F.filter("all", last)).drop("all")
    return told.filter(~F.col("lost") & ~F.exists("deps", lambda e: (e["dep"] == F.col("call_id")) | (e["w"] > F.col("n")))).select(*NODE)


NODE = [*KEY, "n", "k", "deps", "changed"]


def _ordered_large(links: DataFrame) -> DataFrame:
    """The same by rounds of joins, of which a chain of references takes the logarithm of its length.

    In turn, known keys are taken over and lone references are followed, each to where the next one leads, so that ways double; only calls
    with several open references have to wait for one round each along a way.  When nothing changes any more, what is
    left lies in or behind a cycle.  Keys are appended to one table as they become known.
    """
    spark = links.sparkSession
    calls = links.select("conv_id", F.col("call_id").alias("dep"), F.lit(True).alias("refers")).distinct()
    turn, refers = F.col("turn").cast("long"), F.col("refers").isNotNull()
    key = lambda t, d: F.struct(t.cast("long").alias("t"), F.lit(d).cast("long").alias("d"))
    own = written(links.groupBy("conv_id").agg(F.count("*").alias("n")), "sizes")
    told = looked_up(links, ["conv_id", "dep"], calls).groupBy(*KEY).agg(F.max(F.greatest(key(turn, 0), F.when(~refers, key(F.col("dep_turn"), 1)))).alias("k"), F.collect_list(F.when(refers, F.struct("dep", F.lit(1).cast("long").alias("w")))).alias("deps"))
    told = looked_up(written(told, "calls"), "conv_id", own, "inner", own).withColumn("changed", F.lit(True))
    nodes = written(told.filter(~F.exists("deps", lambda e: e["dep"] == F.col("call_id"))).select(*NODE), "refs")
    path = f"{shared_dir(spark)}/ordered-{uuid.uuid4().hex}"
    ready = F.size("deps") == 0
    flat = lambda df: df.select(*KEY, F.col("k.t").alias("t"), F.col("k.d").cast("int").alias("d"))
    flat(nodes.limit(0)).write.parquet(path)
    while not nodes.isEmpty():
        # after this no reference leads to a call with a known key, so these can go
        flat(nodes.filter(ready)).write.mode("append").parquet(path)
        met = written(_met(nodes, False), "refs")
        forget(nodes)
        nodes = written(_met(met, True).unionByName(met.filter(ready)), "refs")
        forget(met)
        if nodes.filter("changed").isEmpty():
            break
    forget(nodes)
    return links.select(*KEY).distinct().join(spark.read.schema(flat(nodes).schema).parquet(path), KEY, "left")


def topological(calls: DataFrame, small: int = SMALL) -> DataFrame:
    """``conv_id, call_id, order_turn, order_depth, missing``: the stable topological key of each (unique) call.

    key = (turn, 0), raised to (t, d + 1) by a dependency with key (t, d) of the same or a later turn.
    Only conversations with a reference forward (or to the call itself) need more than turns; those of
    up to ``small`` references are ordered in one pass, others in rounds of joins, with the same result.
    """
    nodes = calls.select("conv_id", "call_id", "turn")
    edges = written(calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("depends")).alias("dep")).filter("dep is not null"), "edges")
    seen = looked_up(edges, ["conv_id", "dep"], nodes.select("conv_id", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn")).hint("shuffle_hash"))
    seen = written(seen.select("conv_id", "call_id", "turn", "dep", "dep_turn"), "calls")
    missing = seen.filter("dep_turn is null").groupBy(*KEY).agg(F.sort_array(F.collect_set("dep")).alias("missing"))
    links = seen.filter("dep_turn is not null")
    sizes = written(links.groupBy("conv_id").agg(F.count("*").alias("n"), F.bool_or(F.col("dep_turn") >= F.col("turn")).alias("forward")).filter("forward").select("conv_id", "n"), "sizes")
    few, many = (looked_up(links, "conv_id", sizes.filter(c).select("conv_id"), "inner", sizes) for c in (F.col("n") <= small, F.col("n") > small))
    keys = _ordered_small(few)
    if not sizes.filter(F.col("n") > small).isEmpty():
        keys = keys.unionByName(_ordered_large(written(many, "links")))
    out = nodes.join(keys.withColumn("refers", F.lit(True)), KEY, "left").join(missing, KEY, "left")
    known = F.col("refers").isNull() | F.col("t").isNotNull()
    return out.select(*KEY, F.when(known, F.coalesce("t", F.col("turn").cast("long"))).alias("order_turn"), F.when(known, F.coalesce("d", F.lit(0))).alias("order_depth"), "missing")


def firsts(table: DataFrame, fields: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """(the first row of each identifier by its fields, all further rows), of a written table.

    One aggregation finds first rows; rows of identifiers that come more than once are looked up, and equal rows are counted.
    """
    known = table.filter("conv_id is not null and call_id is not null")
    told = known.groupBy(*KEY).agg(F.min(F.struct(*fields)).alias("f"), F.count("*").alias("n"))
    again = told.filter("n > 1").select(*KEY, "f")
    alone = table.filter("conv_id is null or call_id is null").select(*KEY, *fields)
    one = told.select(*KEY, "f.*").unionByName(alone)
    folded = written(known.groupBy(*KEY, *fields).agg(F.count("*").alias("k")), name)
    more = looked_up(folded, KEY, again, "inner")
    times = F.col("k") - F.when(F.struct(*fields).eqNullSafe(F.col("f")), 1).otherwise(0)
    more = more.filter(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*KEY, *fields)
    return one, more


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per call and per result without a call.

    ``conv_id, call_id, tool, call_turn, result_turn, status, errors, order_turn, order_depth, record``;
    ``record`` is canonical JSON of call and result.
    """
    calls = written(calls.select(*KEY, "turn", "tool", "arguments", "depends"), "tool-calls")
    results = written(results.select(*KEY, "turn", "content"), "tool-results")
    one, more = firsts(calls, ["turn", "tool", "arguments", "depends"], "call-rows")
    answer, late = firsts(results, ["turn", "content"], "result-rows")
    order = topological(one.filter("conv_id is not null and call_id is not null"))
    one = one.drop("depends").withColumnRenamed("turn", "call_turn")
    # both sides have one row an identifier, so neither can be skewed (null ones don't meet)
    both = one.join(answer.withColumnRenamed("turn", "result_turn").hint("shuffle_hash"), KEY, "full_outer")
    both = both.withColumn("status", F.when(F.col("call_turn").isNull(), "orphan").when(F.col("result_turn").isNull(), "unanswered").when(F.col("result_turn") <= F.col("call_turn"), "before its call").otherwise("linked"))
    both = both.join(order.hint("shuffle_hash"), KEY, "left")
    more = more.drop("depends").withColumnRenamed("turn", "call_turn").withColumn("status", F.lit("repeated call"))
    late = late.withColumnRenamed("turn", "result_turn").withColumn("status", F.lit("repeated result"))
    both = both.unionByName(more, allowMissingColumns=True).unionByName(late, allowMissingColumns=True)
    args = F.try_parse_json("arguments")
    is_call = ~F.col("status").isin("orphan", "repeated result")
    missing = F.transform(F.coalesce("missing", F.array().cast("array<string>")), lambda m: F.concat(F.lit("no call "), m))
    errors = F.when(is_call, F.array_join(F.concat(argument_errors(F.col("tool"), args, schemas), missing), "; ")).otherwise(F.lit(""))
    canonical = F.coalesce(F.to_json(args), F.lit("null"))
    text = lambda c: F.coalesce(F.expr(f"substr(to_json(struct({c} as v)), 6, length(to_json(struct({c} as v))) - 6)"), F.lit("null"))
    record = F.concat(F.lit('{"arguments":'), canonical, F.lit(',"id":'), F.when(F.col("call_id").isNull(), "null").otherwise(text("call_id")), F.lit(',"result":'), F.when(F.col("content").isNull(), "null").otherwise(text("content")), F.lit(',"tool":'), F.when(F.col("tool").isNull(), "null").otherwise(text("tool")), F.lit("}"))
    return both.select(*KEY, "tool", "call_turn", "result_turn", "status", errors.alias("errors"), "order_turn", "order_depth", record.alias("record"))
