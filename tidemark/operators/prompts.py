"""Prompts as columns, and model answers parsed back into columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import values as V
from tidemark.functions.columns import ColumnLike, col
from tidemark.operators.relational import top_per_group
from tidemark.operators.rules import Rule, first_broken

# Default texts; every builder takes its own instead.
GROUNDED = (
    "Responda somente com base nos documentos a seguir. "
    "Sem resposta neles, diga que a informação não foi encontrada.\n\n"
    "Documentos:\n{context}\n\nPergunta: {question}\n\nResposta:"
)
RFM_REASONING = (
    "Você recebe os números de um cliente e decide o próximo contato com ele.\n"
    "Código: {id_cliente}\nNotas de 1 a 5: recência {r_score}, frequência {f_score}, valor {m_score} (juntas, {rfm_score})\n"
    "Dias sem comprar: {recency_dias}\nPedidos no período: {frequency}\nGasto no período: {monetary}\n\n"
    "Primeiro leia as notas, depois diga qual hábito mudou, por fim escolha um contato e justifique com um dos números.\n\n"
    "Decisão:"
)


def render(template: str, fields: Mapping[str, ColumnLike]) -> Column:
    """The template with ``{name}`` filled from columns; null fields read as empty.

    Values are placed by concatenation, so braces inside them stay as they are.
    """
    parts, at = [], 0
    for slot in re.finditer(r"\{(\w+)\}", template):
        if slot.group(1) not in fields:
            continue
        parts += [F.lit(template[at:slot.start()]), F.coalesce(col(fields[slot.group(1)]).cast("string"), F.lit(""))]
        at = slot.end()
    return F.concat(*parts, F.lit(template[at:]))


def zero_shot(df: DataFrame, task: str, text: str, answer: str, out: str = "prompt") -> DataFrame:
    template = f"{task}\n\nTexto: \"{{text}}\"\n\n{answer}:"
    return df.withColumn(out, render(template, {"text": text}))


def pick_examples(pool: DataFrame, label: str, order: Sequence[Column], per_label: int) -> DataFrame:
    """The first ``per_label`` examples of every label, so that classes differ."""
    return top_per_group(pool, [label], order, per_label, "turn")


def few_shot(
    df: DataFrame,
    examples: DataFrame,
    k: int,
    task: str,
    text: str,
    label: str,
    order: Sequence[str],
    answer: str,
    out: str = "prompt",
) -> DataFrame:
    """Prompt with the first ``k`` examples in ``order`` before the item.

    The examples become one scalar, computed once; the items are not joined or shuffled.
    """
    first = examples.orderBy(*order).limit(k)
    shown = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("t"), F.col(label).cast("string").alias("l"))))
    block = F.array_join(
        F.transform(
            shown,
            lambda e, i: F.concat(
                F.lit("["), (i + 1).cast("string"), F.lit("] \""), e["t"], F.lit(f"\" => {answer}: "), e["l"],
            ),
        ),
        "\n",
    )
    header = first.agg(block.alias("examples")).scalar()
    return df.withColumn(out, F.concat(
        F.lit(f"{task}\n\n"), F.coalesce(header, F.lit("")), F.lit("\n[?] \""), F.col(text), F.lit(f"\" => {answer}:")
    ))


def step_by_step(rfm: DataFrame, template: str = RFM_REASONING, out: str = "prompt") -> DataFrame:
    """Reasoning prompt per customer from the RFM row."""
    return rfm.withColumn(out, render(template, {
        **{c: c for c in rfm.columns}, "monetary": F.format_string("%.2f", F.col("monetary"))
    }))


def answer_layout(schema: T.StructType = V.ANSWER_SCHEMA, choices: Mapping[str, Sequence[str]] | None = None) -> str:
    """The JSON shape a structured prompt asks for."""
    choices = ANSWER_CHOICES if choices is None else choices
    lines = []
    for f in schema:
        if f.name in choices:
            shown = f'"<{"|".join(choices[f.name])}>"'
        elif isinstance(f.dataType, T.ArrayType):
            shown = '["<texto>"]'
        elif isinstance(f.dataType, T.StringType):
            shown = '"<texto>"'
        else:
            shown = "<número>"
        lines.append(f'  "{f.name}": {shown}')
    return "{\n" + ",\n".join(lines) + "\n}"


ANSWER_CHOICES = {"segmento": V.SEGMENTS, "canal_preferencial": V.CONTACT_CHANNELS, "urgencia": V.URGENCIES}


def json_prompt(df: DataFrame, profile: str, fields: Mapping[str, ColumnLike], layout: str | None = None, out: str = "prompt") -> DataFrame:
    """Prompt that asks for one JSON object of the given layout, and nothing else."""
    head = f"Responda apenas com um objeto JSON neste formato:\n{layout or answer_layout()}\n\nPerfil:\n"
    return df.withColumn(out, F.concat(F.lit(head), render(profile, fields), F.lit("\n\nJSON:")))


def with_role(df: DataFrame, role: str, text: str = "prompt", out: str = "messages") -> DataFrame:
    """System and user message as an array of (role, content)."""
    message = lambda who, what: F.struct(F.lit(who).alias("role"), what.alias("content"))
    return df.withColumn(out, F.array(message("system", F.lit(role)), message("user", F.col(text))))


def answer_rules() -> list[Rule]:
    """Value tests of a parsed answer."""
    absent = [
        Rule(f"{f.name} ausente", F.col(f"answer.{f.name}").isNull()) for f in V.ANSWER_SCHEMA
    ]
    unknown = [Rule(f"{c} desconhecido", ~F.col(f"answer.{c}").isin(*allowed)) for c, allowed in ANSWER_CHOICES.items()]
    score = F.col("answer.score_risco_churn")
    return [*absent, *unknown, Rule("score fora de 0-1", ~score.between(0, 1))]


def parse_answers(
    df: DataFrame, text: str, schema: T.StructType = V.ANSWER_SCHEMA, rules: Sequence[Rule] | None = None
) -> DataFrame:
    """Adds ``answer`` (struct or null) and ``problem`` (null for a valid answer).

    A lenient parser stops after the first object, so the text is read as the first item
    of an array that ends with a marker: anything behind the object breaks that array.
    """
    body = F.trim(F.regexp_replace(F.col(text), r"^\s+|\s+$", ""))
    item = T.StructType([*schema.fields, T.StructField("__end", T.IntegerType())])
    listed = F.from_json(F.concat(F.lit("["), body, F.lit(',{"__end":1}]')), T.ArrayType(item))
    whole = (
        body.startswith("{") & body.endswith("}")
        & (F.size("__items") == 2) & F.col("__items")[1]["__end"].eqNullSafe(1)
        & F.col("__items")[0]["__end"].isNull()
    )
    names = schema.fieldNames()
    answer = F.struct(*[F.col("__items")[0][n].alias(n) for n in names])
    parsed = df.withColumn("__items", listed).withColumn("answer", F.when(F.coalesce(whole, F.lit(False)), answer))
    rules = answer_rules() if rules is None else rules
    problem = F.when(F.col("answer").isNull(), "JSON inválido").otherwise(first_broken(rules) if rules else F.lit(None))
    return parsed.withColumn("problem", problem).drop("__items")

