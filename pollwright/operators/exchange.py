"""Model requests and replies as columns; sending them is left to another service."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollwright.constants import MAX_TOKENS
from pollwright.functions.text import strip

# --- fixed values: model families in order of precedence --------------------
FAMILIES = {
    "claude": lambda m: m.contains("anthropic.claude"),
    "qwen": lambda m: F.lower(m).contains("qwen"),
    "deepseek_r1": lambda m: F.lower(m).contains("deepseek") & F.lower(m).contains("r1"),
    "deepseek": lambda m: F.lower(m).contains("deepseek"),
    "nova": lambda m: m.contains("amazon.nova"),
    "llama": lambda m: m.contains("meta.llama"),
    "titan": lambda m: m.contains("amazon.titan"),
    "mistral": lambda m: m.contains("mistral"),
}
DEEPSEEK_R1_FORM = "<｜begin▁of▁sentence｜><｜User｜>{}<｜Assistant｜><think>\n"
LLAMA_FORM = (
    "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n{}<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\n"
)
CLAUDE_VERSION = "bedrock-2023-05-31"
# ----------------------------------------------------------------------------


def family(model: Column) -> Column:
    """First family whose mark the model name holds, ``generic`` for none."""
    found = F.when(F.lit(False), F.lit(""))
    for name, holds in FAMILIES.items():
        found = found.when(holds(model), F.lit(name))
    return found.otherwise("generic")


def _framed(form: str, prompt: Column) -> Column:
    before, after = form.split("{}")
    return F.concat(F.lit(before), prompt, F.lit(after))


def _object(**fields: Column) -> Column:
    return F.struct(*(value.alias(name) for name, value in fields.items()))


def request_payload(model: Column, prompt: Column, max_tokens: int = MAX_TOKENS) -> Column:
    """The JSON body a model family takes."""
    limit, cold, user = F.lit(max_tokens), F.lit(0.0), F.lit("user")

    def messages(content: Column) -> Column:
        return F.array(_object(role=user, content=content))

    part = F.array(_object(type=F.lit("text"), text=prompt))
    bodies = {
        "claude": _object(
            anthropic_version=F.lit(CLAUDE_VERSION), max_tokens=limit, messages=messages(part)
        ),
        "qwen": _object(messages=messages(prompt), max_tokens=limit, temperature=cold),
        "deepseek_r1": _object(
            prompt=_framed(DEEPSEEK_R1_FORM, prompt), max_tokens=limit, temperature=cold,
            top_p=F.lit(1.0),
        ),
        "deepseek": _object(prompt=prompt, max_tokens=limit, temperature=cold),
        "nova": _object(
            messages=messages(F.array(_object(text=prompt))),
            inferenceConfig=_object(max_new_tokens=limit, temperature=cold),
        ),
        "llama": _object(prompt=_framed(LLAMA_FORM, prompt), max_gen_len=limit, temperature=cold),
        "titan": _object(
            inputText=prompt,
            textGenerationConfig=_object(maxTokenCount=limit, temperature=cold),
        ),
        "mistral": _object(prompt=prompt, max_tokens=limit, temperature=cold),
    }
    kind = family(model)
    chosen = F.when(F.lit(False), F.lit(""))
    for name, body in bodies.items():
        chosen = chosen.when(kind == name, F.to_json(body))
    return chosen.otherwise(F.to_json(_object(prompt=prompt, max_tokens=limit)))


def reply_text(model: Column, reply: Column) -> Column:
    """The text in a family's JSON reply, stripped.

    Null where a part that family always has is missing; the caller counts
    that as a failed call. An unknown family's reply is kept as it came.
    """
    at = lambda path: F.get_json_object(reply, path)
    empty = F.lit("")
    has = lambda path: at(path).isNotNull()
    kind = family(model)
    chat = F.when(has("$.choices[0]"), F.coalesce(at("$.choices[0].message.content"), empty))
    completion = F.when(has("$.choices[0]"), F.coalesce(at("$.choices[0].text"), empty))
    outputs = F.when(has("$.outputs"), F.when(has("$.outputs[0]"), F.coalesce(at("$.outputs[0].text"), empty)))
    text = (
        F.when(kind == "claude", at("$.content[0].text"))
        .when(kind == "qwen", F.coalesce(chat, at("$.output"), reply))
        .when(
            kind.startswith("deepseek"),
            F.coalesce(completion, at("$.generation"), at("$.output"), empty),
        )
        .when(kind == "nova", at("$.output.message.content[0].text"))
        .when(kind == "llama", F.coalesce(at("$.generation"), empty))
        .when(kind == "titan", at("$.results[0].outputText"))
        .when(kind == "mistral", F.when(has("$.outputs"), outputs).otherwise(empty))
        .otherwise(reply)
    )
    return strip(text)


def envelope(text: Column, error: Column, seconds: Column) -> Column:
    """One call's outcome; it failed if there is an error or no text at all."""
    success = text.isNotNull() & error.isNull()
    return F.struct(
        F.when(success, text).otherwise("").alias("response"),
        success.alias("success"),
        F.when(~success, F.coalesce(error, F.lit("reply lacks its text"))).alias("error"),
        seconds.cast("double").alias("response_time"),
    )
