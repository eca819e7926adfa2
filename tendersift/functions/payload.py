"""Values from nested payloads of unknown shape and from judge or synthesis answers.

Finding a key at any depth has no built-in form, so one small Arrow function lists the nodes that
carry a wanted key; every rule about those nodes is a Spark expression on that list. The payload
is read once per row and nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("is_list", T.BooleanType())]))

NODE_JSON = json.JSONEncoder(ensure_ascii=False).encode   # json.dumps makes a new encoder for every call

# fixed values: keys of the three payload schemas
AMOUNT_KEYS = ("EstimatedOverallContractAmount", "TotalAmount", "PayableAmount")
OLD_AMOUNT_KEY = "VALEUR"
MONTH_KEYS = ("nbMois", "DUREE_MOIS")
DURATION_KEY = "DurationMeasure"
LINK_KEYS = ("urlProfilAcheteur", "BuyerProfileURI", "URL_PROFIL_ACHETEUR")
CODE_KEY, CODE_LIST, OLD_CODE_KEY = "ItemClassificationCode", "cpv", "CPV"
FRAMEWORK_KEY, FRAMEWORK_TYPE_KEY, FRAMEWORK_LIST = (
    "ACCORD_CADRE", "ContractingSystemTypeCode", "framework-agreement")
FREE_CRITERIA_KEY, CRITERION_KEY, WEIGHTED_KEY = "CRITERES_LIBRE", "CRITERE", "criterePondere"
WANTED = (*AMOUNT_KEYS, OLD_AMOUNT_KEY, *MONTH_KEYS, DURATION_KEY, *LINK_KEYS, CODE_KEY, OLD_CODE_KEY,
          FRAMEWORK_KEY, FRAMEWORK_TYPE_KEY, FREE_CRITERIA_KEY, CRITERION_KEY, WEIGHTED_KEY)


def _items(doc: object) -> Iterator[tuple[str, str, object]]:
    """(dotted path, key, value) of every key at any depth, in document order."""
    todo = [("", doc)]
    while todo:
        path, cur = todo.pop()
        if isinstance(cur, tuple):
            yield path, cur[0], cur[1]
            todo.append((path + ".", cur[1]))
        elif isinstance(cur, dict):
            todo.extend((path + k, (k, v)) for k, v in reversed(cur.items()))
        elif isinstance(cur, list):
            todo.extend((path, v) for v in reversed(cur))


def _keyed(doc: object) -> Iterator[tuple[str, object]]:
    """(key, value) as `_items` gives them, without the paths."""
    todo = [doc]
    while todo:
        cur = todo.pop()
        if isinstance(cur, tuple):
            yield cur
            cur = cur[1]
        if isinstance(cur, dict):
            todo.extend(reversed(cur.items()))
        elif isinstance(cur, list):
            todo.extend(reversed(cur))


def _load(raw: str | None) -> object:
    try:
        return json.loads(raw) if raw else None
    except ValueError:
        return None


def _text(v: object) -> str | None:
    t = v.get("#text") if isinstance(v, dict) else v
    return t if isinstance(t, str) and t else None


def nodes_with_keys(payload: Column, keys: Sequence[str]) -> Column:
    """JSN1 and JSN2: array of (key, node as JSON, text, is_list) for every wanted key, any depth.

    The key is compared without its namespace prefix and without case; a bad payload has no nodes.
    """
    names = {k.lower(): k for k in keys}

    @F.arrow_udf(NODE)
    def find(raw: pa.Array) -> pa.Array:
        ends, key, node, text, is_list = [0], [], [], [], []
        for r in raw:
            for k, v in _keyed(_load(r.as_py())):
                if n := names.get(k.rsplit(":", 1)[-1].lower()):
                    key.append(n)
                    node.append(NODE_JSON(v))
                    text.append(_text(v))
                    is_list.append(isinstance(v, list))
            ends.append(len(key))
        nodes = pa.StructArray.from_arrays([pa.array(key, pa.string()), pa.array(node, pa.string()), pa.array(text, pa.string()),
                                            pa.array(is_list, pa.bool_())], ["key", "node", "text", "is_list"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), nodes)

    return find(payload)


def key_paths(payload: Column) -> Column:
    """SRC12: the distinct dotted key paths of one payload; explode and distinct for a table."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def paths(s: pd.Series) -> pd.Series:
        return s.map(lambda raw: sorted({p for p, _, _ in _items(_load(raw))}))

    return paths(payload)


def _of(nodes: Column, key: str) -> Column:
    return F.filter(nodes, lambda n: n["key"] == key)


def _first_text(nodes: Column, key: str) -> Column:
    """First node of a key that carries text."""
    return F.get(F.filter(nodes, lambda n: (n["key"] == key) & n["text"].isNotNull()), F.lit(0))


def _attr(node: Column, name: str) -> Column:
    return F.get_json_object(node["node"], f"$['{name}']")


def payload_amount(nodes: Column) -> Column:
    """JSN3: struct(amount, currency) of the first key that has a text."""
    best = F.coalesce(*[_first_text(nodes, k) for k in AMOUNT_KEYS])
    old = _first_text(nodes, OLD_AMOUNT_KEY)
    return F.struct(F.coalesce(best["text"], old["text"]).alias("amount"),
                    F.when(best.isNotNull(), _attr(best, "@currencyID"))
                    .otherwise(_attr(old, "@DEVISE")).alias("currency"))


def payload_codes(nodes: Column) -> Column:
    """JSN4 and AGG10: distinct sorted codes of both schemas."""
    new = F.transform(F.filter(_of(nodes, CODE_KEY), lambda n: n["text"].isNotNull()
                               & (F.coalesce(_attr(n, "@listName"), F.lit("")) == CODE_LIST)), lambda n: n["text"])

    def principal(n: Column) -> Column:
        one = _attr(n, "PRINCIPAL")
        as_list = F.from_json(one, "array<string>")
        in_list = F.transform(F.from_json(n["node"], "array<struct<PRINCIPAL:string>>"), lambda x: x["PRINCIPAL"])
        return (F.when(n["is_list"], in_list).when(F.startswith(one, F.lit("[")), as_list)
                .otherwise(F.array(one)))

    old = F.flatten(F.transform(_of(nodes, OLD_CODE_KEY), principal))
    return F.array_sort(F.array_distinct(F.filter(F.concat(new, F.coalesce(old, F.array().cast("array<string>"))),
                                                  lambda x: x.isNotNull() & (x != ""))))


def payload_duration(nodes: Column) -> Column:
    """JSN5."""
    months = [F.concat(_first_text(nodes, k)["text"], F.lit(" mois")) for k in MONTH_KEYS]
    d = _first_text(nodes, DURATION_KEY)
    unit = F.lower(_attr(d, "@unitCode"))
    return F.coalesce(*months, F.when(d.isNotNull(), F.concat_ws(" ", d["text"], F.nullif(unit, F.lit("")))))


def payload_is_framework(nodes: Column) -> Column:
    """JSN6."""
    flag = F.exists(nodes, lambda n: n["key"] == FRAMEWORK_KEY)
    typed = F.exists(nodes, lambda n: F.coalesce(
        (n["key"] == FRAMEWORK_TYPE_KEY) & (_attr(n, "@listName") == FRAMEWORK_LIST) & (n["text"] != "none"),
        F.lit(False)))
    return F.coalesce(flag | typed, F.lit(False))


def payload_link(nodes: Column) -> Column:
    """JSN7."""
    return F.coalesce(*[_first_text(nodes, k)["text"] for k in LINK_KEYS])


def payload_criteria(nodes: Column) -> Column:
    """AGG11: `text (weight%) ; …` over the three ways criteria are written."""
    free = F.transform(F.filter(_of(nodes, FREE_CRITERIA_KEY), lambda n: n["text"].isNotNull()), lambda n: n["text"])

    def weighted(key: str, text: str, weight: str) -> Column:
        schema = f"array<struct<`{text}`:string,`{weight}`:string>>"

        def items(n: Column) -> Column:
            as_list = F.when(n["is_list"], n["node"]).otherwise(F.concat(F.lit("["), n["node"], F.lit("]")))
            return F.coalesce(F.from_json(as_list, schema), F.from_json(F.lit("[]"), schema))

        def show(i: Column) -> Column:
            w = F.nullif(i[weight], F.lit(""))
            return F.when(w.isNotNull(), F.concat(i[text], F.lit(" ("), w, F.lit("%)"))).otherwise(i[text])

        flat = F.flatten(F.transform(_of(nodes, key), items))
        return F.transform(F.filter(flat, lambda i: i.isNotNull() & (F.coalesce(i[text], F.lit("")) != "")), show)

    parts = F.concat(free, weighted(CRITERION_KEY, "#text", "@POIDS"),
                     weighted(WEIGHTED_KEY, "critere", "criterePCT"))
    return F.nullif(F.array_join(parts, " ; "), F.lit(""))


def answer_items(raw: Column) -> Column:
    """JSN8: array of judged items from a tolerant read; null when nothing usable is found."""
    s = F.regexp_extract(raw, r"(?s)\[.*\]", 0)
    schema = "array<struct<id:string,score_global:string,verdict:string,pole_principal:string,raison:string>>"
    return F.from_json(F.nullif(s, F.lit("")), schema)


def answer_object(raw: Column, fields: Sequence[str]) -> Column:
    """JSN9: struct of text fields from an answer that may sit inside a code fence."""
    s = F.regexp_replace(F.trim(raw), r"(?s)^```(?:json)?\s*|\s*```$", "")
    return F.from_json(s, "struct<" + ",".join(f"`{f}`:string" for f in fields) + ">")


def place_of(posting: Column) -> Column:
    """JSN10: place of a JSON-LD posting (text): locality, else region, else the plain address."""
    def get(p: str) -> Column:
        return F.nullif(F.get_json_object(posting, p), F.lit(""))
    address = F.coalesce(get("$.jobLocation.address"), get("$.jobLocation[0].address"))
    plain = F.when(~F.startswith(address, F.lit("{")), address)
    out = [get(f"$.jobLocation{i}.address.{f}") for f in ("addressLocality", "addressRegion") for i in ("", "[0]")]
    return F.coalesce(*out, plain, F.lit(""))
