"""Large transfers inside nested transaction JSON, and the decision kept for every event.

``evaluate`` parses each document once and needs no shuffle: the qualifying
messages of an event stay an array on its own row until they are exploded.
Explode an expression over ``hits``, not the bare column: for a bare column the
optimizer adds a size filter, and pushing that down evaluates everything twice.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, functions as F

from walletscope import params
from walletscope.functions import event_id, plain_amount, sanitize_json, short_address, transfer_text
from walletscope.functions.amounts import INTEGER
from walletscope.session import require_prepared
from walletscope.sources.documents import with_document
from walletscope.sources.pages import with_transactions

_STRICT = {"columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false",
           "allowNonNumericNumbers": "false"}
_MESSAGE = "struct<value: string, source: variant, destination: variant>"
_PARTS = f"in_msg: {_MESSAGE}, out_msgs: array<{_MESSAGE}>"


def _typed(tx: str, root: str = f", {_PARTS}") -> str:
    return f"doc array<struct<transactions: array<struct<{tx}>>{root}>>, _bad string"


_LOOSE = "doc array<struct<transactions: variant, in_msg: variant, out_msgs: variant>>, _bad string"
_ANY = "doc array<string>, _bad string"
_HITS = ("array<struct<tx_position: int, direction: string, amount: decimal(38,9), "
         "message: string, error: boolean>>")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _child(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _text(value: Column) -> Column:
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value, which is evaluated once however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _members(value: Column) -> Column:
    """Kind and members of an address leaf; the members of a leaf that is no object are NULL."""
    return F.struct(_kind(value).alias("kind"), value.alias("value"),
                    *(_child(value, name).alias(name) for name in ("address", "workchain_id", "raw_form")))


def _object_address(leaf: Column) -> Column:
    """Text address inside an address object; NULL or blank means look at ``raw_form``."""
    return F.nullif(_text(leaf["address"]), F.lit(""))


def message_address(value: Column) -> Column:
    """Address text of a string or object leaf, ``unknown`` for every other kind."""
    def from_object(leaf: Column, plain: Column) -> Column:
        workchain = leaf["workchain_id"]
        number = F.when(_kind(workchain) == "BIGINT", F.try_variant_get(workchain, "$", "int"))
        prefixed = F.when(number.isNotNull() & ~F.contains(plain, F.lit(":")),
                          F.concat(number.cast("string"), F.lit(":"), plain)).otherwise(plain)
        return F.coalesce(prefixed, _text(leaf["raw_form"]))

    def found(leaf: Column) -> Column:
        return (F.when(leaf["kind"] == "STRING", F.try_variant_get(leaf["value"], "$", "string"))
                .when(leaf["kind"].startswith("OBJECT"),
                      _bound(_object_address(leaf), lambda plain: from_object(leaf, plain))))

    return F.coalesce(_bound(_members(value), found), F.lit(params.UNKNOWN_ADDRESS))


def _address_error(value: Column) -> Column:
    """Object leaves that cannot be read: non-numeric workchain, non-text raw form."""
    def bad(leaf: Column) -> Column:
        workchain, raw_form = _kind(leaf["workchain_id"]), _kind(leaf["raw_form"])
        unread = F.when(_object_address(leaf).isNotNull(), workchain.isNotNull() & ~(
            workchain.isin("BIGINT", "FLOAT", "DOUBLE") | workchain.startswith("DECIMAL"))
        ).otherwise(raw_form.isNotNull() & ~raw_form.isin("STRING", "VOID"))
        return F.when(leaf["kind"].startswith("OBJECT"), unread)

    return F.coalesce(_bound(_members(value), bad), F.lit(False))


def _variant_null(value: Column) -> Column:
    return F.coalesce(F.is_variant_null(value), F.lit(False))


def _as_shape(listed: Column) -> Column:
    """A document read for its ``transactions`` alone, in the shape of a whole one."""
    docs = F.transform(listed["doc"], lambda d: F.struct(
        d["transactions"].alias("transactions"), F.lit(None).cast(_MESSAGE).alias("in_msg"),
        F.lit(None).cast(f"array<{_MESSAGE}>").alias("out_msgs")))
    return F.when(listed.isNotNull(), F.struct(docs.alias("doc"), listed["_bad"].alias("_bad")))


def _null_member(root: Column) -> Column:
    """Whether ``transactions``, ``in_msg`` or ``out_msgs`` of a loosely read document is present but null."""
    listed = F.try_variant_get(root["transactions"], "$", "array<variant>")
    in_listed = F.exists(listed, lambda t: _variant_null(_child(t, "in_msg"))
                         | _variant_null(_child(t, "out_msgs")))
    return F.when(root["transactions"].isNotNull(),
                  _variant_null(root["transactions"]) | F.coalesce(in_listed, F.lit(False))
                  ).otherwise(_variant_null(root["in_msg"]) | _variant_null(root["out_msgs"]))


def _status(raw: Column, shape: Column, root: Column, as_any: Column) -> Column:
    """``ok``, ``raw_json_parse_error`` (not JSON) or ``evaluation_error`` (JSON, wrong shape).

    A wrong shape inside an object still leaves a partial document, so an object without
    one is not JSON. ``root`` and ``as_any`` are further readings of the body, NULL for
    rows that do not need them.
    """
    doc = F.get(shape["doc"], F.lit(0))
    is_json = as_any["_bad"].isNull() & (F.size(as_any["doc"]) == 1)
    null_element = F.when(
        doc["transactions"].isNotNull(),
        F.exists(doc["transactions"],
                 lambda t: t.isNull() | F.coalesce(F.exists(t["out_msgs"], lambda m: m.isNull()),
                                                   F.lit(False)))
    ).otherwise(F.coalesce(F.exists(doc["out_msgs"], lambda m: m.isNull()), F.lit(False)))
    return (F.when(raw.isNull(), params.EVALUATION_ERROR)
            .when(shape["_bad"].isNotNull(),
                  F.when(_unread_object(raw, shape), params.RAW_JSON_PARSE_ERROR)
                  .when(is_json, params.EVALUATION_ERROR).otherwise(params.RAW_JSON_PARSE_ERROR))
            .when(F.size(shape["doc"]) != 1, params.RAW_JSON_PARSE_ERROR)
            .when(doc.isNull() | null_element, params.EVALUATION_ERROR)
            .when(root.isNotNull() & _null_member(root), params.EVALUATION_ERROR)
            .otherwise("ok"))


def _unread_object(raw: Column, shape: Column) -> Column:
    return shape["doc"].isNull() & raw.rlike(r"^\s*\{")


def _messages(tx: Column, position: Column) -> Column:
    """Messages of one transaction: the incoming one first, then outgoing in order."""
    def entry(m: Column, direction: str) -> Column:
        digits = F.regexp_extract(m["value"], INTEGER, 1)
        return F.struct(position.alias("tx_position"), F.lit(direction).alias("direction"),
                        digits.alias("digits"), m["source"].alias("source"),
                        m["destination"].alias("destination"))

    incoming = F.array(entry(tx["in_msg"], "IN"))
    outgoing = F.transform(tx["out_msgs"], lambda m: entry(m, "OUT"))
    return F.when(outgoing.isNull(), incoming).otherwise(F.concat(incoming, outgoing))


def message_list(events: DataFrame) -> DataFrame:
    """Add ``messages``: the present messages of the document in order, whatever form it has."""
    message = f"array<{_MESSAGE}>"
    parsed = with_document(events, "raw_json", f"struct<transactions: array<struct<{_PARTS}>>, {_PARTS}>", "_doc")
    doc, none = F.col("_doc"), F.array().cast(message)
    single = F.struct(doc["in_msg"].alias("in_msg"), doc["out_msgs"].alias("out_msgs"))
    txs = F.when(doc["transactions"].isNotNull(), doc["transactions"]).otherwise(F.array(single))

    def of(tx: Column) -> Column:
        return F.concat(F.filter(F.array(tx["in_msg"]), lambda m: m.isNotNull()), F.coalesce(tx["out_msgs"], none))

    return parsed.withColumn("messages", F.flatten(F.transform(txs, of))).drop("_doc")


def _least_nano(threshold) -> Decimal:
    return (Decimal(str(threshold)) * params.NANO_PER_UNIT).to_integral_value(ROUND_CEILING)


def _may_qualify(raw: Column, threshold) -> Column:
    """Cheap necessary condition for any alert or unreadable value, checked on the text before it is parsed.

    A large enough value needs that many digits in a row, unless some are written
    as escapes; so does one beyond all limits.
    """
    least = _least_nano(threshold)
    if least <= 0:
        return F.lit(True)
    digits = min(len(str(least)), len(str(int(params.MAX_DECIMAL_UNITS))))
    return raw.rlike(f"[0-9]{{{digits}}}") | F.contains(raw, F.lit("\\u"))


def _qualifying(messages: Column, threshold) -> Column:
    """Messages that reach the threshold or cannot be evaluated.

    One small step per array pass: lambda bodies share no subexpressions, so each
    value is bound once before it is used several times.
    """
    limit, least = Decimal(params.MAX_DECIMAL_UNITS), _least_nano(threshold)

    def nano(m: Column) -> Column:
        return F.struct(m["tx_position"].alias("tx_position"), m["direction"].alias("direction"),
                        m["digits"].try_cast("decimal(29,0)").alias("nano"),
                        m["source"].alias("source"), m["destination"].alias("destination"))

    def judged(m: Column) -> Column:
        peer = F.when(m["direction"] == "IN", m["source"]).otherwise(m["destination"])
        text = _bound(message_address(peer), lambda a: transfer_text(m["direction"], a, a))
        amount = (m["nano"] / F.lit(params.NANO_PER_UNIT).cast("decimal(10,0)")).cast("decimal(38,9)")
        error = (m["nano"].isNull() | (F.abs(m["nano"]) > limit)
                 | _address_error(m["source"]) | _address_error(m["destination"]))
        return F.struct(m["tx_position"].alias("tx_position"), m["direction"].alias("direction"),
                        amount.alias("amount"), text.alias("message"), error.alias("error"))

    numeric = F.filter(messages, lambda m: m["digits"] != "")
    large = F.filter(F.transform(numeric, nano), lambda m: m["nano"].isNull()
                     | (m["nano"] >= least) | (m["nano"] < -limit))
    return F.transform(large, judged)


def evaluate(events: DataFrame, threshold=params.ALERT_THRESHOLD, scope: str = "page") -> DataFrame:
    """Add ``status`` and ``hits``, the array of qualifying transfers of each event.

    ``scope="page"`` walks every transaction of the event's document, so each
    event of a page reports all transfers of the page. ``scope="own_tx"`` keeps
    only the transaction whose lt and hash are the event's own. An event with any
    unreadable message reports nothing (all or nothing).
    """
    if scope not in ("page", "own_tx"):
        raise ValueError(f"unknown scope {scope!r}")
    require_prepared(events.sparkSession)
    raw = F.col("raw_json")
    body = F.concat(F.lit('{"doc":['), raw, F.lit("]}"))
    own = scope == "own_tx"
    tx = f"{_PARTS}, lt: string, hash: string" if own else _PARTS
    first = F.col("_first")
    beside = first["_bad"].isNotNull() & F.get(first["doc"], F.lit(0))["transactions"].isNotNull()
    shaped = (events.withColumn("_first", F.from_json(body, _typed(tx), _STRICT))
              .withColumn("_listed", F.when(beside, F.from_json(body, _typed(tx, ""), _STRICT)))
              .withColumn("_shape", F.when(beside, _as_shape(F.col("_listed"))).otherwise(first))
              .drop("_first", "_listed"))
    # Further readings stand in columns of their own, NULL where a row does not need them, so that
    # none of them runs once per mention.
    shape = F.col("_shape")
    loose = F.get(F.from_json(body, _LOOSE, _STRICT)["doc"], F.lit(0))
    untyped = F.from_json(body, _ANY, _STRICT)
    shaped = (shaped
              .withColumn("_root", F.when(shape["_bad"].isNull() & F.contains(raw, F.lit("null")), loose))
              .withColumn("_any", F.when(shape["_bad"].isNotNull() & ~_unread_object(raw, shape), untyped)))
    doc = F.get(F.col("_shape.doc"), F.lit(0))
    txs = doc["transactions"]
    if own:
        mine = F.filter(txs, lambda t: (t["lt"] == F.col("lt").cast("string"))
                        & (t["hash"] == F.col("tx_hash")))
        txs = F.transform(mine, lambda t: F.struct(t["in_msg"].alias("in_msg"),
                                                   t["out_msgs"].alias("out_msgs")))
    single = F.struct(doc["in_msg"].alias("in_msg"), doc["out_msgs"].alias("out_msgs"))
    txs = F.when(doc["transactions"].isNotNull(), txs).otherwise(F.array(single))
    found = F.when(_may_qualify(raw, threshold), _qualifying(F.flatten(F.transform(txs, _messages)), threshold)
                   ).otherwise(F.array().cast(_HITS))
    staged = (shaped.withColumn("_status", _status(raw, shape, F.col("_root"), F.col("_any")))
              .withColumn("_found", F.when(F.col("_status") == "ok", found)).drop("_shape", "_root", "_any"))
    broken = F.exists("_found", lambda a: a["error"])
    return (staged
            .withColumn("status", F.when(broken, params.EVALUATION_ERROR).otherwise(F.col("_status")))
            .withColumn("hits", F.when(~broken, F.col("_found"))).drop("_status", "_found"))


def whale_alerts(events: DataFrame, threshold=params.ALERT_THRESHOLD, scope: str = "page",
                 asset_id: str = params.ALERT_ASSET, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per qualifying transfer of each event, in document order (``position``).

    ``extra`` names further event columns to keep.
    """
    likely = events.where(_may_qualify(F.col("raw_json"), threshold))
    return alert_rows(evaluate(likely, threshold, scope), asset_id, extra)


def alert_rows(judged: DataFrame, asset_id: str = params.ALERT_ASSET,
               extra: tuple[str, ...] = ()) -> DataFrame:
    """The alerts of evaluated events, one row each."""
    hits = F.coalesce("hits", F.array().cast(_HITS))
    kept = ["event_id", "chain", "address", "provider", "correlation_id", *extra]
    return (judged.select(*kept, F.posexplode(hits).alias("position", "_hit"))
            .select(*kept, "position", F.lit(asset_id).alias("asset_id"), F.col("address").alias("wallet"),
                    "_hit.amount", "_hit.direction", "_hit.message"))


def page_alerts(pages: DataFrame, scope: str = "page", threshold=params.ALERT_THRESHOLD) -> DataFrame:
    """Alerts of page documents (chain, provider, address, body), each page parsed once.

    Equals ``whale_alerts`` over the normalised events of the pages, without
    carrying and re-parsing the body per transaction. With ``scope="page"`` a page
    of N transactions and Q transfers gives N x Q rows, which is what the alert
    semantics say; the fetch limit bounds N.
    """
    read = evaluate(with_transactions(pages).withColumn("raw_json", sanitize_json(F.col("body"))),
                    threshold)
    txs = F.when(F.col("hits").isNotNull(), F.col("txs"))
    per_tx = read.select("chain", "provider", "address", "hits",
                         F.posexplode(txs).alias("_at", "_tx"))
    own = (F.coalesce("hits", F.array().cast(_HITS)) if scope == "page" else
           F.filter("hits", lambda h: h["tx_position"] == F.col("_at")))
    return (per_tx.select("chain", "provider", "address", "_tx", F.posexplode(own).alias("position", "_hit"))
            .select(event_id("chain", "address", F.col("_tx.lt"), F.col("_tx.hash")).alias("event_id"),
                    "chain", "address", "provider", F.col("_tx.lt").alias("lt"), "position",
                    "_hit.amount", "_hit.direction", "_hit.message"))


def decisions(events: DataFrame, decided_at: Column, threshold=params.ALERT_THRESHOLD,
              scope: str = "page") -> DataFrame:
    """One audit row per alert (``sent``), or one per event without any.

    Events that end in ``evaluation_error`` leave no decision; see ``failed_events``.
    """
    return decision_rows(evaluate(events, threshold, scope), decided_at)


def decision_rows(judged: DataFrame, decided_at: Column) -> DataFrame:
    """The audit rows of evaluated events; ``decided_at`` is evaluated on those."""
    # The choice of rows sits in the generator: a filter on the status would be
    # pushed below the evaluation and run it twice.
    no_hits = F.array().cast(_HITS)
    found = F.coalesce("hits", no_hits)
    listed = (F.when(F.col("status") == params.EVALUATION_ERROR, no_hits)
              .when(F.size(found) > 0, found)
              .otherwise(F.array(F.lit(None)).cast(_HITS)))
    rows = judged.select(decided_at.alias("decided_at"), "event_id", "chain", "address", "provider",
                         "correlation_id", "status", F.posexplode(listed).alias("position", "_hit"))
    sent = F.col("_hit").isNotNull()
    failed = F.col("status") == params.RAW_JSON_PARSE_ERROR
    return rows.select(
        "decided_at", F.lit(params.DECISION_CATEGORY).alias("category"),
        F.when(sent, "sent").when(failed, "failed").otherwise("suppressed").alias("outcome"),
        F.when(sent, F.lit(None)).when(failed, params.RAW_JSON_PARSE_ERROR)
        .otherwise(params.NO_QUALIFYING_TRANSFER).alias("reason_code"),
        F.when(sent, "console").otherwise("none").alias("channel"),
        "event_id", "correlation_id", "chain", "address", "provider",
        "position",
        F.when(sent, params.ALERT_ASSET).alias("asset_id"), F.col("_hit.direction").alias("direction"),
        F.col("_hit.amount").alias("amount"), F.col("_hit.message").alias("message"))


def failed_events(events: DataFrame, threshold=params.ALERT_THRESHOLD) -> DataFrame:
    """Events whose JSON is valid but of the wrong shape: kept for repair, no alert, no decision."""
    return evaluate(events, threshold).where(F.col("status") == params.EVALUATION_ERROR).drop("hits")


def alert_lines(alerts: DataFrame) -> DataFrame:
    """The human-readable line of each alert."""
    line = F.concat(
        F.lit(params.ALERT_LINE_PREFIX), F.col("asset_id"), F.lit(" - "), short_address(F.col("wallet")),
        F.lit(" "), F.col("direction"), F.lit(" "), plain_amount(F.col("amount")), F.lit(" | "),
        F.col("message"), F.lit(". CorrelationId: "),
        F.coalesce("correlation_id", F.lit("(null)")))
    return alerts.withColumn("line", line)


def decision_lines(rows: DataFrame) -> DataFrame:
    """Audit JSON lines: camelCase names, nulls left out, ISO-8601 UTC time."""
    stamp = F.concat(F.date_format("decided_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("0+00:00"))
    document = F.struct(
        stamp.alias("timestamp"), "category", "outcome", F.col("reason_code").alias("reasonCode"),
        "channel", F.col("event_id").alias("eventId"),
        F.col("correlation_id").alias("correlationId"), "chain", "address", "provider",
        F.col("asset_id").alias("assetId"), "direction",
        F.parse_json(plain_amount(F.col("amount"))).alias("amount"), "message")
    return rows.withColumn("line", F.to_json(document))
