"""Adapters: (file, pos, raw) records to documents, and what follows them.

Each adapter gives two expressions of raw, the id that the record carries (null
if none) and its text, and optionally the reason to skip it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import BLANK, ensure_text, first_truthy, let, lines_of, path_id, stable_u, strip
from ..functions.variant import as_array, as_string, canonical, display, is_object, is_there, member, objects, parse_json, to_text, truthy_text

ACTIONS = ("code_action", "tool_call", "function_call", "action")
THOUGHTS = ("code_action.description", "thought", "reasoning")
ROLES = {
    "user": ("human", "user", "user_input", "human_input"),
    "assistant": ("assistant", "gpt", "model", "model_response", "ai"),
    "tool": ("tool", "tool_output", "output", "observation", "tool_return", "execution_result", "text_observation"),
    "system": ("system", "instruction", "rules"),
}
#: Not in any text: open and close the role of a chat-log block.
_ROLE, _END = "\ue0a1", "\ue0a2"


def _strings() -> Column:
    return F.array().cast("array<string>")


def _some(condition: Column, part: Column) -> Column:
    return F.when(condition, F.array(part)).otherwise(_strings())


def map_role(role: Column) -> Column:
    """A5: one of four roles; what isn't known speaks as the assistant."""
    def named(r: Column) -> Column:
        out = F.lit("assistant")
        for name, aliases in ROLES.items():
            out = F.when(r.isin(*aliases), name).otherwise(out)
        return out

    return let(F.lower(strip(role)), named)


def wrap_content(role: Column, content: Column) -> Column:
    """Calls and thoughts in their spans."""
    call = F.concat(F.lit("<|tool_call|>\n"), content, F.lit("\n</|tool_call|>"))
    thought = F.concat(F.lit("<think>\n"), content, F.lit("\n</think>"))
    return let(F.lower(strip(role)), lambda r: F.when(r.isin(*ACTIONS), call).when(r.isin(*THOUGHTS), thought).otherwise(content))


def role_block(role: Column, content: Column) -> Column:
    return strip(F.concat(F.lit("<|"), role, F.lit("|>\n"), content))


def mapped_block(role: Column, content: Column) -> Column:
    return F.when(role != "", role_block(map_role(role), wrap_content(role, content))).otherwise(content)


def joined(parts: Column, by: str = "\n\n") -> Column:
    return strip(F.array_join(F.flatten(F.coalesce(parts, F.array().cast("array<array<string>>"))), by))


# --- toucan: A1 to A3 --------------------------------------------------------------------------------------------


def toucan_messages(raw: Column) -> Column:
    """The message objects, listed or as a JSON text."""
    v = member(raw, "messages")
    return objects(F.coalesce(as_array(v), as_array(parse_json(as_string(v)))))


def duplicate_calls(messages: Column) -> Column:
    """A2: do two messages carry the same function call?"""
    calls = F.filter(F.transform(messages, lambda m: member(m, "function_call")), is_there)
    keys = F.transform(calls, lambda c: F.coalesce(as_string(c), canonical(c)))
    return F.coalesce(F.size(keys) > F.size(F.array_distinct(keys)), F.lit(False))


def toucan_parts(m: Column) -> Column:
    """A3: a message's blocks. A tool's content takes the place of the message's last block."""
    seen = F.named_struct(F.lit("role"), F.coalesce(as_string(member(m, "role")), F.lit("")), F.lit("content"), strip(F.coalesce(as_string(member(m, "content")), F.lit(""))), F.lit("call"), member(m, "function_call"))

    def parts(x: Column) -> Column:
        role, content, call = x["role"], x["content"], x["call"]
        calls = is_there(call)
        payload = F.when(is_object(call), display(call)).otherwise(to_text(call))
        span = F.concat(F.lit("<|tool_call|>\n"), payload, F.lit("\n</|tool_call|>"))
        block = F.when(strip(role) != "", role_block(strip(role), content)).otherwise(content)
        result = role_block(F.lit("tool_output"), content)
        says, is_tool = content != "", role.isin("tool", "function") & (content != "")
        return F.when(is_tool, F.when(calls, F.array(block, result)).otherwise(F.array(result))).otherwise(F.concat(_some(says, block), _some(calls, span)))

    return let(seen, parts)


def toucan(raw: Column) -> tuple[Column, Column, Column]:
    messages = toucan_messages(raw)
    text = joined(F.transform(messages, toucan_parts))
    question = as_string(member(raw, "question"))
    skip = F.when(duplicate_calls(messages), "duplicate_function_call")
    return as_string(member(raw, "uuid")), first_truthy(text, question), skip


# --- agent data: A4 to A9 ----------------------------------------------------------------------------------------


def turn_parts(m: Column) -> Column:
    """Role by the first that is set; content by the first key that is there, even if it is null."""
    role = strip(F.coalesce(*[truthy_text(member(m, k)) for k in ("role", "from", "speaker", "name")], F.lit("")))
    has = lambda k: member(m, k).isNotNull()
    value = F.when(has("content"), member(m, "content")).when(has("value"), member(m, "value")).otherwise(member(m, "text"))
    seen = F.named_struct(F.lit("role"), role, F.lit("content"), strip(to_text(value)))
    return let(seen, lambda x: _some(x["content"] != "", mapped_block(x["role"], x["content"])))


def step_parts(s: Column) -> Column:
    """The description of an action comes before its content, any other after it."""
    role = strip(F.coalesce(*[truthy_text(member(s, k)) for k in ("source", "class_")], F.lit("")))
    seen = F.named_struct(F.lit("role"), role, F.lit("main"), strip(to_text(member(s, "content"))), F.lit("about"), strip(to_text(member(s, "description"))))

    def parts(x: Column) -> Column:
        about_role = F.when(x["role"] != "", F.concat(x["role"], F.lit(".description"))).otherwise("description")
        first = _some(x["main"] != "", mapped_block(x["role"], x["main"]))
        second = _some(x["about"] != "", let(about_role, lambda r: role_block(map_role(r), wrap_content(r, x["about"]))))
        return let(F.array(first, second), lambda p: F.when(F.lower(x["role"]).isin(*ACTIONS), F.concat(p[1], p[0])).otherwise(F.concat(p[0], p[1])))

    return let(seen, parts)


def agent_data(raw: Column) -> tuple[Column, Column, None]:
    routes = [joined(F.transform(objects(as_array(member(raw, k))), f)) for k, f in (("conversations", turn_parts), ("messages", turn_parts), ("content", step_parts))]
    fields = [strip(as_string(member(raw, k))) for k in ("question", "prompt", "instruction", "text", "input")]
    return as_string(member(raw, "id")), first_truthy(*routes, *fields), None


# --- the others: A10 to A15 --------------------------------------------------------------------------------------


def glaive(raw: Column) -> tuple[None, Column, None]:
    system, chat = (F.coalesce(as_string(member(raw, k)), F.lit("")) for k in ("system", "chat"))
    return None, F.concat(system, F.lit("\n\n"), chat), None


def task_action(text: Column) -> Column:
    """A task and an agent's action as two blocks, split at the first action; null if it isn't one."""

    def split(t: Column, at: Column) -> Column:
        task, action = strip(F.substring(t, F.lit(1), at - 1)), strip(F.substring(t, at + 8, F.length(t)))
        out = strip(F.concat(F.lit("<|user|>\n"), task, F.lit("\n\n<|assistant|>\nAction:\n"), action))
        return F.when(F.startswith(t, F.lit("Task:")) & (at > 0) & F.contains(t, F.lit("Agent.")), out)

    return let(strip(text), lambda t: let(F.instr(t, F.lit("\nAction:")), lambda at: split(t, at)))


def chat_log(text: Column) -> Column:
    """Lines that name a speaker open blocks, lines before the first are dropped; without any, the text as it is."""
    pattern = rf"(?i)^(user|assistant)[{BLANK}]*:[{BLANK}]*(.*)$"

    def opened(line: Column, s: Column) -> Column:
        head = F.concat(F.lit(_ROLE), F.lower(F.regexp_extract(s, pattern, 1)), F.lit(_END), F.regexp_extract(s, pattern, 2))
        return F.when(s.rlike(pattern), head).otherwise(line)

    marked = F.transform(lines_of(text), lambda line: let(strip(line), lambda s: opened(line, s)))
    pieces = F.split(F.array_join(marked, "\n"), _ROLE, -1)
    after_first = let(pieces, lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))))

    def block(b: Column) -> Column:
        content = strip(F.substring_index(b, _END, -1))
        return strip(F.concat(F.lit("<|"), F.substring_index(b, _END, 1), F.lit("|>\n"), content))

    return let(after_first, lambda blocks: F.when(F.size(blocks) > 0, F.array_join(F.transform(blocks, block), "\n\n")).otherwise(text))


def hephaestus(raw: Column) -> tuple[Column, Column, None]:
    text = F.coalesce(as_string(member(raw, "text")), F.lit(""))
    return as_string(member(raw, "id")), F.coalesce(task_action(text), chat_log(text)), None


def math_parts(m: Column) -> Column:
    """Role, an assistant's reasoning, content; each if it isn't blank."""
    said = F.array(*[strip(F.coalesce(as_string(member(m, k)), F.lit(""))) for k in ("role", "reasoning_content", "content")])
    return let(said, lambda x: F.concat(_some(x[0] != "", x[0]), _some((x[0] == "assistant") & (x[1] != ""), x[1]), _some(x[2] != "", x[2])))


def math(raw: Column) -> tuple[Column, Column, None]:
    return as_string(member(raw, "uuid")), joined(F.transform(objects(as_array(member(raw, "messages"))), math_parts), "\n"), None


def pretraining(raw: Column) -> tuple[Column, Column, None]:
    return as_string(member(raw, "id")), as_string(member(raw, "text")), None


#: What a config's adapter.kind names. register() adds to it.
ADAPTERS: dict[str, Callable[[Column], tuple]] = {
    "toucan": toucan,
    "agent-data-collection": agent_data,
    "glaive": glaive,
    "hephaestus": hephaestus,
    "nemotron-math-v2": math,
    "nemotron-pretraining-sft-v1": pretraining,
}


def register(kind: str, adapter: Callable[[Column], tuple]) -> None:
    ADAPTERS[kind] = adapter


def adapt(records: DataFrame, kind: str, dataset: str, config: str = "", system_ratio: float = 0.0, with_raw: bool = False, keep_skipped: bool = False) -> DataFrame:
    """Records to documents (id, text, metadata), without skipped records and empty texts.

    metadata.raw is only there if asked for: it would make the scan read every column.
    """
    if kind not in ADAPTERS:
        raise ValueError(f"unknown adapter kind: {kind}")
    raw = F.col("raw")
    own, text, skip = ADAPTERS[kind](raw)
    where = path_id(F.col("file"), F.col("pos"))
    doc_id = where if own is None else F.coalesce(F.nullif(own, F.lit("")), where)
    metadata = [F.lit(dataset).alias("dataset"), F.lit(kind).alias("adapter"), F.lit(config).alias("_config"), (F.lit(None).cast("string") if skip is None else skip).alias("skip_reason")]
    if with_raw:
        metadata.append(raw.alias("raw"))
    docs = records.select(doc_id.alias("id"), ensure_text(text).alias("text"), F.struct(*metadata).alias("metadata"), as_string(member(raw, "system")).alias("__system"))
    if not keep_skipped:
        docs = docs.where((F.col("text") != "") & F.col("metadata.skip_reason").isNull())
    ratio = min(1.0, max(0.0, float(system_ratio)))
    if ratio > 0:
        docs = docs.withColumn("text", system_mixin(F.col("id"), F.col("text"), F.col("__system"), ratio))
    return docs.drop("__system")


def system_mixin(doc_id: Column, text: Column, system: Column, ratio: float) -> Column:
    """System instructions before the text, for a stable share of ids."""
    system = strip(F.coalesce(system, F.lit("")))
    chosen = (doc_id != "") & (stable_u(doc_id) < ratio) & (system != "")
    return F.when(chosen, F.concat(F.lit("SYSTEM:\n"), system, F.lit("\n\n"), text)).otherwise(text)


def prepare(docs: DataFrame, mixed: bool = False) -> DataFrame:
    """The training record {uuid, text}; in mixed mode the dataset goes before the id."""
    uuid = F.concat(F.col("metadata.dataset"), F.lit("::"), "id") if mixed else F.col("id")
    return docs.select(uuid.alias("uuid"), "text")
