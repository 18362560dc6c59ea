"""Task forms: settings with their gates and warnings, rows of scripts, scripts written back all or none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipweave.functions.text import seconds_to_say, ustrip, violations
from clipweave.sources import row_list

# Statuses of a form that is filled in; strengths by number, and the one that stands for others.
READY = ("已填写", "完成", "OK", "ok")
STRENGTHS = ("轻", "中", "强")
ITEMS = {
    "status": "状态", "scopes": "处理范围", "do_slice": "长视频切片入库", "do_shorts": "短视频直接入库", "scripts_from": "话术来源", "opening": "开头策略",
    "mix_count": "混剪成片数", "mix_rows": "混剪话术", "strength": "去重强度", "size": "混剪规格",
}


def is_yes(answer: Column, yes: str = "是") -> Column:
    return F.coalesce(answer, F.lit(yes)).startswith(yes)


def strength(answer: Column) -> Column:
    """By name or by number from 1; the middle one for what can't be read."""
    by_number = F.get(F.array(*map(F.lit, STRENGTHS)), F.coalesce(answer.try_cast("int"), F.lit(0)) - 1)
    return F.when(answer.isin(*STRENGTHS), answer).otherwise(F.coalesce(by_number, F.lit(STRENGTHS[1])))


def settings(answers: DataFrame, known: tuple[str, ...], n_scripts: int, keys: list[str] | None = None, items: dict[str, str] | None = None) -> DataFrame:
    """One row for each form (keys) of (line_no, item, answer) rows; of repeated items the last counts. What is not known or can't be
    read is left out or replaced, with a warning."""
    keys, items = keys or [], items or ITEMS
    answer = lambda name: F.max_by(F.when(F.col("item") == items[name], F.nullif(ustrip(F.col("answer")), F.lit(""))), F.when((F.col("item") == items[name]), F.col("line_no")))
    held = answers.groupBy(*keys).agg(*(answer(n).alias(n) for n in items))
    listed = F.filter(F.transform(F.split(F.coalesce("scopes", F.lit("")), "\n"), ustrip), lambda x: x != "")
    every = F.array(*map(F.lit, known))
    asked = F.when(F.size(listed) == 0, every).otherwise(listed)
    count = F.col("mix_count").try_cast("int")
    odd = F.transform(F.array_except(asked, every), lambda x: F.concat(F.lit("unknown scope: "), x))
    no_number = F.when(F.col("mix_count").isNotNull() & count.isNull(), F.array(F.lit("the number of mixes is none"))).otherwise(F.array().cast("array<string>"))
    return held.select(
        *keys, F.coalesce(F.col("status").isin(*READY), F.lit(False)).alias("ready"),
        F.filter(asked, lambda x: F.array_contains(every, x)).alias("scopes"), F.concat(odd, no_number).alias("warnings"),
        is_yes(F.col("do_slice")).alias("do_slice"), is_yes(F.col("do_shorts")).alias("do_shorts"), "scripts_from", "opening",
        F.greatest(F.lit(1), F.coalesce(count, F.lit(5))).alias("mix_count"), row_list(F.col("mix_rows"), n_scripts).alias("mix_rows"),
        strength(F.col("strength")).alias("strength"), F.coalesce("size", F.lit("1080x1920")).alias("size"),
    )


def chosen_scripts(scripts: DataFrame, rows: DataFrame, number: str = "number") -> DataFrame:
    """The scripts (number, text) that a list of rows (place, number) names, in its order."""
    return rows.join(scripts, number)


def script_for(scripts: Column, turn: Column) -> Column:
    """Scripts in turn, from 0; null if there are none."""
    return F.get(scripts, F.when(F.size(scripts) > 0, turn % F.size(scripts)).cast("int"))


def checked(scripts: DataFrame, price: Column, appearance: Column, forbidden: Column) -> DataFrame:
    """Scripts (number, text) that aren't blank, stripped, plus faults."""
    rows = scripts.withColumn("text", ustrip(F.col("text"))).where("text <> ''")
    return rows.withColumn("faults", violations(F.col("text"), price, appearance, forbidden))


def to_form(scripts: DataFrame, price: Column, appearance: Column, forbidden: Column) -> DataFrame:
    """Form rows (number, text, seconds, fault): all the scripts, numbered anew, if none is at fault; else only those at fault."""
    from clipweave.operators.ledgers import numbered
    from clipweave.storage import stored

    rows = stored(checked(scripts, price, appearance, forbidden), "scripts")
    bad = rows.where(F.size("faults") > 0)
    if not bad.isEmpty():
        return bad.select(F.col("number").cast("long").alias("number"), "text", F.lit(None).cast("double").alias("seconds"), F.array_join("faults", "; ").alias("fault"))
    return numbered(rows.drop("faults").withColumnRenamed("number", "_was"), ["_was", "text"]).select("number", "text", seconds_to_say(F.col("text")).alias("seconds"), F.lit(None).cast("string").alias("fault"))


def sheet_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, label, values) of a fact sheet's rows (label, value): a blank label continues the one above; values in order."""
    from clipweave.operators.library import carried

    named = carried(rows.withColumn("label", ustrip(F.col("label"))), keys, order, "label").withColumn("value", ustrip(F.col("value")))
    held = named.where("label IS NOT NULL AND value <> ''").groupBy(*keys, "label").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), "value"))).alias("v"))
    return held.select(*keys, "label", F.transform("v", lambda x: x["value"]).alias("values"))


def simple_yaml(text: str) -> dict:
    """A driver-side reader of settings: `key: scalar`, `key:` with `- item` lines or indented settings below, and comments."""
    import json

    def scalar(said: str):
        said = said.split(" #")[0].strip()
        if said[:1] in "\"'" and said[-1:] == said[:1] and len(said) > 1:
            return said[1:-1]
        try:
            return json.loads(said)
        except ValueError:
            return {"": None, "yes": True, "no": False, "~": None}.get(said, said)

    root: dict = {}
    stack: list[tuple[int, dict, str | None]] = [(-1, root, None)]
    for raw in text.splitlines():
        said = raw.strip()
        if not said or said.startswith("#"):
            continue
        depth = len(raw) - len(raw.lstrip())
        if said.startswith("- "):
            _, holder, key = stack[-1]
            if key is not None:
                if not isinstance(holder.get(key), list):
                    holder[key] = []
                holder[key].append(scalar(said[2:]))
            continue
        while depth <= stack[-1][0]:
            stack.pop()
        _, holder, key = stack[-1]
        if key is not None:
            if not isinstance(holder.get(key), dict):
                holder[key] = {}
            holder = holder[key]
        name, _, value = said.partition(":")
        holder[name.strip()] = scalar(value)
        stack.append((depth, holder, name.strip()))
    return root


def setting(tree: dict, path: str, otherwise=None):
    """The setting at a dotted path."""
    for name in path.split("."):
        if not isinstance(tree, dict) or name not in tree:
            return otherwise
        tree = tree[name]
    return tree
