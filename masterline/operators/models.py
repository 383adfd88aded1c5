"""External models behind typed steps: enrichment, tags, categories, consolidation, confirmation.

A model is a function of plain values that may answer with None, with blanks, or fail in any way; what a step
returns then is stated with it. Every step has a deterministic model of its own for work without a network.
"""

from __future__ import annotations

import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masterline.functions import text as T
from masterline.operators import clusters as C
from masterline.operators import taxonomy
from masterline.operators.budget import CallBudget
from masterline.operators.ids import row_numbers

#: Descriptions that are drawn for a supplier's tags, those that the model gets to see, and low-confidence lines
#: that a consolidating model gets to see: features of the prompts, not of the data.
DRAWN, SHOWN, REVIEWED = 100, 50, 50
CONFIRMED_AT_ONCE = 10


class RateLimiter:
    """At most `per_minute` calls in any 60 seconds: wait() sleeps until one more is allowed."""

    def __init__(self, per_minute: int = 30, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.per_minute, self.clock, self.sleep = per_minute, clock, sleep
        self.calls: deque[float] = deque()

    def wait(self) -> None:
        now = self.clock()
        while self.calls and now - self.calls[0] >= 60:
            self.calls.popleft()
        if len(self.calls) >= self.per_minute:
            self.sleep(60 - (now - self.calls[0]))
            self.calls.popleft()
        self.calls.append(self.clock())


class Transport:
    """A model whose calls have a time limit, and are tried again after a pause that doubles.

    A call that isn't over in `seconds` counts as failed; it is left to end by itself. The last failure is raised.
    """

    def __init__(self, model: Callable[[dict], Mapping | None], seconds: float = 60.0, retries: int = 3, pause: float = 0.5) -> None:
        self.model, self.seconds, self.retries, self.pause = model, seconds, max(1, retries), pause

    def __call__(self, row: dict) -> Mapping | None:
        for left in reversed(range(self.retries)):
            done: queue.Queue = queue.Queue()
            threading.Thread(target=self._call, args=(row, done), daemon=True).start()
            try:
                answer, failure = done.get(timeout=self.seconds)
            except queue.Empty:
                failure = TimeoutError(f"no answer in {self.seconds} s")
            if failure is None:
                return answer
            if left:
                time.sleep(self.pause * 2 ** (self.retries - 1 - left))
        raise failure

    def _call(self, row: dict, done: queue.Queue) -> None:
        try:
            done.put((self.model(row), None))
        except Exception as failure:  # noqa: BLE001  an external model may fail in any way
            done.put((None, failure))


def answered(rows: DataFrame, model: Callable[[dict], Mapping | None], fields: Mapping[str, tuple[str, object]], per_minute: int | None = None, budget: CallBudget | None = None) -> DataFrame:
    """rows with the fields (name -> type, default) of the model's answer about each row.

    A field that the answer lacks or leaves blank, and all of them where the model fails or answers None, take
    their default. A field named error, if asked for, gets the failure's message. budget limits the calls of all tasks
    together, per_minute those of each task.
    """
    columns = rows.columns
    kinds = {"string": str, "double": float, "array<string>": list}

    def one(row: dict) -> list:
        try:
            answer = model(row) or {}
        except Exception as failure:  # noqa: BLE001  an external model may fail in any way
            answer = {"error": f"{type(failure).__name__}: {failure}"[:500]}
        out = []
        for name, (kind, default) in fields.items():
            value = answer.get(name) if isinstance(answer, Mapping) else None
            try:
                out.append(kinds[kind](value) if value not in (None, "", []) else default)
            except (TypeError, ValueError):
                out.append(default)
        return out

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = budget or (RateLimiter(per_minute) if per_minute else None)
        for frame in frames:
            found = []
            for row in frame.to_dict("records"):
                if limiter:
                    limiter.wait()
                found.append(one(row))
            for i, name in enumerate(fields):
                frame[name] = pd.Series([x[i] for x in found], index=frame.index, dtype="float64" if fields[name][0] == "double" else "object")
            yield frame

    known = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.select(*columns).mapInPandas(run, known + "".join(f", `{n}` {k}" for n, (k, _) in fields.items()))


def enrich(suppliers: DataFrame, model: Callable[[dict], Mapping | None] = lambda row: None, per_minute: int | None = None) -> DataFrame:
    """suppliers with description, employee_count, revenue, year_established and confidence."""
    fields = {"description": ("string", "Not available"), "employee_count": ("string", "Unknown"), "revenue": ("string", "Unknown"), "year_established": ("string", "Unknown"), "confidence": ("double", 0.0)}
    return answered(suppliers, model, fields, per_minute)


def frequent_words(row: dict) -> dict:
    """Offline tags: up to five different words of the shown descriptions, by how often they come, then by name."""
    seen: dict[str, int] = {}
    for text in row["shown"]:
        for word in set(text.lower().split()):
            seen[word] = seen.get(word, 0) + (len(word) > 2)
    return {"tags": [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if n][:5]}


def product_tags(lines: DataFrame, supplier: str, description: str, model: Callable[[dict], Mapping | None] = frequent_words, per_minute: int | None = None) -> DataFrame:
    """supplier, n_drawn, tags: the model sees SHOWN of the DRAWN descriptions of each supplier.

    Different descriptions, trimmed, neither blank nor nan, are drawn in the order of a hash, so a rerun draws
    alike, and a supplier with any number of lines holds no more in a task. No descriptions, no row.
    """
    clean = T.strip(F.col(description).cast("string"))
    different = lines.select(supplier, clean.alias("_d")).filter((F.col("_d") != "") & (F.lower("_d") != "nan")).distinct()
    drawn = different.withColumn("_n", F.row_number().over(Window.partitionBy(supplier).orderBy(F.md5("_d"), "_d"))).filter(F.col("_n") <= DRAWN)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("_n", "_d"))), lambda x: x["_d"])
    shown = drawn.groupBy(supplier).agg(ordered.alias("_all")).select(supplier, F.size("_all").cast("long").alias("n_drawn"), F.slice("_all", 1, SHOWN).alias("shown"))
    return answered(shown, model, {"tags": ("array<string>", [])}, per_minute).drop("shown")


def first_candidate(row: dict) -> dict:
    """Offline classifier: the best candidate, with the share of the description's tokens that it scores."""
    best = row["candidates"][0]
    share = min(1.0, best["score"] / max(1, len(set(row["description"].lower().split()))))
    return {**{k: best[k] for k in ("l1", "l2", "l3")}, "confidence": share, "l3_probability": share, "reasoning": "token overlap"}


def classify(descriptions: DataFrame, description: str, categories: DataFrame, model: Callable[[dict], Mapping | None] = first_candidate, per_minute: int | None = None) -> DataFrame:
    """description, l1, l2, l3, confidence, l3_probability, reasoning: one path for each different description, out
    of its best candidates. An answer that isn't a candidate, or none, is Unclassified with confidence 0."""
    best = taxonomy.top_categories(descriptions, description, categories)
    some = best.groupBy("description").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "l1", "l2", "l3", "score"))), lambda c: F.struct(c["l1"].alias("l1"), c["l2"].alias("l2"), c["l3"].alias("l3"), c["score"].alias("score"))).alias("candidates"))

    def checked(row: dict) -> Mapping | None:
        answer = model(row)
        path = tuple((answer or {}).get(k) for k in ("l1", "l2", "l3"))
        return answer if path in {(c["l1"], c["l2"], c["l3"]) for c in row["candidates"]} else None

    fields = {"l1": ("string", "Unclassified"), "l2": ("string", "UNCLASSIFIED"), "l3": ("string", "Unclassified"), "confidence": ("double", 0.0), "l3_probability": ("double", 0.0), "reasoning": ("string", "")}
    return answered(some, checked, fields, per_minute).drop("candidates")


def shared_words(row: dict) -> dict:
    """Offline consolidation: a low line moves to the first established category with which its description shares
    most words, at least half of them; else it stays."""
    moves = []
    for item in row["items"]:
        words = set(item["description"].lower().split())
        shares = [len(words & {w for s in c["samples"] for w in s.lower().split()}) for c in row["established"]]
        if words and max(shares) * 2 >= len(words):
            moves.append({"item_id": item["item_id"], "to_category_id": shares.index(max(shares))})
    return {"reassignments": moves}


def consolidate(lines: DataFrame, supplier: str, key: str, description: str, model: Callable[[dict], Mapping | None] = shared_words, least: float = 0.6, per_minute: int | None = None) -> DataFrame:
    """lines(supplier, key, description, l1, l2, l3, confidence, ...) after a model has reviewed low confidences.

    Per supplier, categories with lines of at least `least` are established, numbered by their first line; the
    first REVIEWED low lines, by key, are numbered and shown with them. An answer names a line and a category by
    number; numbers out of range, and a supplier without lines of either kind, change nothing. Confidences stay.
    """
    split = taxonomy.consolidation_split(lines, least=least)
    high = taxonomy.category_samples(split.filter("part = 'high'"), supplier, description, key)
    established = high.groupBy(supplier).agg(F.array_sort(F.collect_list(F.struct(F.col("first").alias("_first"), "l1", "l2", "l3", "avg_confidence", "samples"))).alias("established"))
    # the rank itself is compared, so that no more than REVIEWED lines of a supplier and task are shuffled
    rank = F.row_number().over(Window.partitionBy(supplier).orderBy(key, description, "l1", "l2", "l3"))
    low = split.filter("part = 'low'").select(supplier, key, description, "l1", "l2", "l3", "confidence").withColumn("_rank", rank).filter(F.col("_rank") <= REVIEWED).withColumn("item_id", F.col("_rank") - 1)
    items = low.groupBy(supplier).agg(F.array_sort(F.collect_list(F.struct("item_id", F.col(key).alias("line"), F.coalesce(description, F.lit("")).alias("description"), "l1", "l2", "l3", "confidence"))).alias("items"))
    asked = established.join(items, supplier)
    line_type = lines.schema[key].dataType.simpleString()
    schema = f"{key} {line_type}, answer int, l1 string, l2 string, l3 string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = RateLimiter(per_minute) if per_minute else None
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                if limiter:
                    limiter.wait()
                try:
                    moves = (model(row) or {}).get("reassignments") or []
                except Exception:  # noqa: BLE001  an external model may fail in any way
                    moves = []
                for n, move in enumerate(moves):
                    item, to = (move.get("item_id", -1), move.get("to_category_id", -1)) if isinstance(move, Mapping) else (-1, -1)
                    if move and 0 <= item < len(row["items"]) and 0 <= to < len(row["established"]):
                        c = row["established"][to]
                        out.append((row["items"][item]["line"], n, c["l1"], c["l2"], c["l3"]))
            yield pd.DataFrame(out, columns=[key, "answer", "l1", "l2", "l3"])

    return taxonomy.reassign(lines, asked.mapInPandas(run, schema), key)


def same_company(row: dict) -> dict:
    """Offline confirmation: names of a cluster are one company if all have the same first word."""
    return {"results": [{"cluster_id": c["cluster_id"], "same_company": len({n.lower().split()[0] for n in c["names"]}) == 1} for c in row["clusters"]]}


def confirm_clusters(found: DataFrame, status: DataFrame, model: Callable[[dict], Mapping | None] = same_company, per_minute: int | None = None) -> DataFrame:
    """name, canonical_name of every name of found(block, cluster, name), with status from clusters.confirm.

    Confirmed clusters go by their canonical name, singletons by their own. Ambiguous ones are sent to the model
    in batches of CONFIRMED_AT_ONCE: of one company, they go by the canonical name, of several or not answered,
    each name by its own; where the model fails, the canonical name stays.
    """
    canonical = C.canonical_names(found, ["block", "cluster"])
    doubtful = found.join(status.filter("status = 'ambiguous'").select("block", "cluster"), ["block", "cluster"]).groupBy("block", "cluster").agg(F.array_sort(F.collect_list("name")).alias("names"))
    batched = row_numbers(doubtful, [F.col("block"), F.col("cluster")], "_n").withColumn("batch", F.floor((F.col("_n") - 1) / CONFIRMED_AT_ONCE))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_n").reset_index(drop=True)
        given = {"clusters": [{"cluster_id": i, "names": list(names)} for i, names in enumerate(group["names"])]}
        try:
            results = model(given)
            verdicts = {x["cluster_id"]: bool(x.get("same_company")) for x in results["results"] if isinstance(x, Mapping) and "cluster_id" in x}
            group["one"] = [verdicts.get(i, False) for i in range(len(group))]
        except Exception:  # noqa: BLE001  an external model may fail in any way
            group["one"] = True
        return group[["block", "cluster", "one"]]

    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    verdicts = batched.groupBy("batch").applyInPandas(run, f"block {kinds['block']}, cluster {kinds['cluster']}, one boolean")
    named = found.join(canonical, ["block", "cluster"]).join(verdicts, ["block", "cluster"], "left")
    return named.select("name", F.when(F.coalesce("one", F.lit(True)), F.col("canonical_name")).otherwise(F.col("name")).alias("canonical_name"))
