"""Queue ingestion: dedupe, done-check, batches, rows, additive schemas and upserts as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions.scalars import EMPTY_JSON, HASH_FIELDS, KEY_FIELDS, MESSAGE_FIELDS, dedupe_key, folded, identifier, json_text, message_hash, normalize_identifier, variant_texts

META = ("meta_message_hash", "meta_row_index", "meta_entity_type", "meta_entity_id", "meta_provider", "meta_league", "meta_season", "meta_source_path", "meta_source_created_at", "payload_json", "meta_ingested_at")
#: Entity types whose payload is one object, and those whose payload is a list of objects.
SINGLE, LISTS = ("match", "player_profile"), ("match_lineup", "team", "player")
BATCH = 100


def queue_message(df: DataFrame, **fields: Column) -> DataFrame:
    """Eight-field envelope; ``created_at`` is the time in ISO form unless given."""
    given = {"created_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"), **fields}
    return df.select(*[given[k].alias(k) for k in (*MESSAGE_FIELDS, "created_at")])


def object_of(raw: str) -> Column:
    """The object (a variant) a text holds, or null if it is anything but one JSON object; the parser alone would overlook what follows."""
    items = F.try_parse_json(F.concat(F.lit("["), raw, F.lit("]"))).try_cast("array<variant>")
    one = (F.size(items) == 1) & F.endswith(F.rtrim(F.regexp_replace(raw, "\\s+$", "")), F.lit("}"))
    return F.when(one & F.startswith(F.schema_of_variant(F.get(items, F.lit(0))), F.lit("OBJECT")), F.get(items, F.lit(0)))


def parsed_messages(lines: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep``, the eight fields as text, and ``as_json``: the JSON form of each, of lines (``raw``) that hold an object.

    A field may hold any JSON value; keys besides the eight are left out.
    """
    v = lines.select(*keep, object_of("raw").alias("v_")).filter("v_ is not null")
    fields = (*MESSAGE_FIELDS, "created_at")
    values = F.array(*[F.try_variant_get("v_", f"$.{f}", "variant") for f in fields])
    texts = F.transform(values, lambda x: F.struct(*[t.alias(n) for n, t in zip(("json", "plain"), variant_texts(x), strict=True)]))
    named = v.select(*keep, texts.alias("t_"))
    return named.select(*keep, *[F.col("t_")[i]["plain"].alias(f) for i, f in enumerate(fields)], F.map_from_arrays(F.array(*map(F.lit, fields)), F.col("t_.json")).alias("as_json"))


def with_hashes(messages: DataFrame) -> DataFrame:
    """Adds ``message_hash`` and ``dedupe_key``; both see a field's JSON value where ``as_json`` tells it, else the column's type."""
    kinds = dict(messages.dtypes)
    told = "as_json" in kinds
    json = {f: F.col("as_json")[f] if told else json_text(F.col(f), kinds[f]) for f in {*HASH_FIELDS, *KEY_FIELDS}}
    texts = {f: F.when(~json[f].isin(*EMPTY_JSON), F.col(f).cast("string")) for f in KEY_FIELDS}
    return messages.withColumns({"message_hash": message_hash(json, F.col("entity_id").cast("string")), "dedupe_key": dedupe_key(texts)})


def split_duplicates(messages: DataFrame, keys: tuple[str, ...] = ("dedupe_key",), order: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """(first of each key in file order, the others with their status)."""
    ranked = messages.withColumn("rn_", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    return ranked.filter("rn_ = 1").drop("rn_"), ranked.filter("rn_ > 1").drop("rn_").withColumn("status", F.lit("duplicate_in_pending"))


def split_done(messages: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages not done yet, those already done): by key, or by five folded fields where the event has no key.

    Two equi-joins instead of one condition with OR; each message gets one flag, and both results are filters on it.
    """
    done = events.filter("status = 'done'")
    league = "league_key" if "league_key" in events.columns else "league"
    keyed = done.filter("dedupe_key is not null").select("dedupe_key", F.lit(True).alias("by_key_")).distinct()
    legacy = done.filter("dedupe_key is null").select(*[folded(F.col(league if f == "league" else f)).alias(f"f_{f}") for f in KEY_FIELDS], F.lit(True).alias("by_fields_")).distinct()
    on = [folded(messages[f]) == legacy[f"f_{f}"] for f in KEY_FIELDS]
    flagged = messages.join(legacy, on, "left").join(keyed, "dedupe_key", "left")
    hit = F.col("by_key_").isNotNull() | F.col("by_fields_").isNotNull()
    fresh = flagged.filter(~hit).select(*messages.columns)
    return fresh, flagged.filter(hit).select(*messages.columns).withColumn("status", F.lit("already_done_in_db"))


def batch_split(messages: DataFrame, size: int = BATCH) -> tuple[DataFrame, DataFrame]:
    """The first ``size`` messages in file order, and the rest; only the batch's last line number is looked up."""
    last = messages.orderBy("line_no").limit(size).agg(F.max("line_no").alias("last"))
    both = messages.crossJoin(F.broadcast(last))  # one row
    own = F.coalesce(F.col("line_no") <= F.col("last"), F.lit(False))
    return both.filter(own).drop("last"), both.filter(~own).drop("last")


def payload_error(entity: Column, payload: Column) -> Column:
    """Why a payload (a variant) has no rows for its entity type, or null.  The texts are fixed values."""
    kind = F.schema_of_variant(payload)
    items = F.transform(payload.try_cast("array<variant>"), lambda v: F.startswith(F.schema_of_variant(v), F.lit("OBJECT")))
    about = lambda text: F.concat(F.lit("Payload for "), entity, F.lit(text))
    single = F.when(payload.isNull() | ~F.startswith(kind, F.lit("OBJECT")), about(" must be a JSON object"))
    listed = F.when(payload.isNull() | ~F.startswith(kind, F.lit("ARRAY")), about(" must be a list")).when(F.exists(items, lambda ok: ~ok), about(" contains non-object items"))
    return F.when(entity.isin(*SINGLE), single).when(entity.isin(*LISTS), listed).otherwise(F.concat(F.lit("Unsupported entity_type: "), F.coalesce(entity, F.lit(""))))


def to_rows(payloads: DataFrame) -> DataFrame:
    """One row per object of each payload: ``message_hash, meta_row_index`` (from 0, in the payload's order), ``row`` (a variant).

    ``payloads``: ``message_hash, entity_type, payload`` (a variant); those with a :func:`payload_error` are left out.
    """
    good = payloads.filter(payload_error(F.col("entity_type"), F.col("payload")).isNull())
    listed = F.when(F.col("entity_type").isin(*SINGLE), F.array("payload")).otherwise(F.col("payload").try_cast("array<variant>"))
    return good.select("message_hash", "entity_type", F.posexplode(listed).alias("meta_row_index", "row"))


def text_of_variant(v: Column) -> Column:
    """A stored value's text: texts plain, True and False, JSON for objects and lists, null for null."""
    kind = F.schema_of_variant(v)
    nested = F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))
    return F.when(kind == "VOID", F.lit(None).cast("string")).when(kind == "BOOLEAN", F.initcap(F.to_json(v))).when(nested, F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))


def dynamic_rows(rows: DataFrame, messages: DataFrame, names: list[str]) -> DataFrame:
    """Meta columns, ``payload_json``, and one text column for each of ``names`` (see :func:`payload_names`).

    Of two keys that normalise alike the later one counts.
    """
    entries = F.map_entries(F.col("row").try_cast("map<string,variant>"))
    named = F.transform(entries, lambda e: F.struct(dynamic_name(e["key"]).alias("n"), text_of_variant(e["value"]).alias("v")))
    meta = messages.select("message_hash", F.col("entity_id").cast("string").alias("meta_entity_id"), F.col("provider").alias("meta_provider"), F.col("league").alias("meta_league"), F.col("season").try_cast("int").alias("meta_season"), F.col("path").alias("meta_source_path"), F.try_to_timestamp("created_at").alias("meta_source_created_at"))
    wide = rows.withColumn("named", named).join(meta, "message_hash")
    value = lambda n: F.try_element_at(F.filter("named", lambda e: e["n"] == n), F.lit(-1))["v"]
    return wide.select(
        F.col("message_hash").alias("meta_message_hash"), "meta_row_index", F.col("entity_type").alias("meta_entity_type"), "meta_entity_id", "meta_provider", "meta_league", "meta_season", "meta_source_path", "meta_source_created_at",
        F.to_json("row").alias("payload_json"), F.current_timestamp().alias("meta_ingested_at"), *[value(n).alias(n) for n in names],
    )


def dynamic_name(key: Column) -> Column:
    """The column for a payload key: normalised, with 'src_' where it clashes with a meta column."""
    n = normalize_identifier(key)
    return F.when(n.isin(*META), F.concat(F.lit("src_"), n)).otherwise(n)


def payload_names(rows: DataFrame) -> DataFrame:
    """``name``: the distinct columns that the keys of all rows ask for."""
    keys = F.map_keys(F.col("row").try_cast("map<string,variant>"))
    return rows.select(F.explode(keys).alias("k")).distinct().select(dynamic_name(F.col("k")).alias("name")).distinct()


def dynamic_names(columns: list[str]) -> dict[str, str]:
    """Source column -> normalised, unique name; clashes with meta columns get 'src_'.

    Two columns that normalise alike share a name: the last one's value counts.
    """
    return {c: f"src_{n}" if (n := identifier(c)) in META else n for c in columns}


def last_of(df: DataFrame, keys: list[str], order: Column | None) -> DataFrame:
    """The last row of each key by ``order`` (by all other columns where none is given), in one aggregation."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg((F.max_by(row, order) if order is not None else F.max(row)).alias("r_"))
    return picked.select(*[F.col(c) if c in keys else F.col("r_")[c].alias(c) for c in df.columns])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = (), order: Column | None = None) -> DataFrame:
    """New rows replace old ones of the same key; columns are merged by name; ``keep`` holds its first value.

    Of several new rows of a key the last by ``order`` counts.
    """
    new = last_of(new, keys, order)
    rest = old.join(new.select(*keys), keys, "left_anti")
    if keep:
        first = old.select(*keys, *[F.col(c).alias(f"old_{c}") for c in keep])
        new = new.join(first, keys, "left").withColumns({c: F.coalesce(f"old_{c}", c) for c in keep}).drop(*[f"old_{c}" for c in keep])
    return rest.unionByName(new, allowMissingColumns=True)


def upsert_events(old: DataFrame, new: DataFrame, order: Column | None = None) -> DataFrame:
    """On a known message hash only status, error and processing time change; of several new rows of a hash the last by ``order`` counts."""
    changing = ("status", "error_message" if "error_message" in old.columns else "error", "processed_at")
    new = last_of(new, ["message_hash"], order)
    n = new.select(F.col("message_hash"), *[F.col(c).alias(f"n_{c}") for c in changing], F.lit(True).alias("hit"))
    kept = old.join(n, "message_hash", "left").withColumns({c: F.when(F.col("hit"), F.col(f"n_{c}")).otherwise(F.col(c)) for c in changing}).drop("hit", *[f"n_{c}" for c in changing])
    return kept.unionByName(new.join(old.select("message_hash"), "message_hash", "left_anti"), allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the rows whose key is not there yet, one of each key."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def merged(*frames: DataFrame) -> DataFrame:
    """Union of all rows; columns by name, missing ones null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def run_counters(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))
