from conftest import plan_of, rows
from pyspark.sql import functions as F

from tidemark.operators import prompts as P

GOOD = '{"segmento":"Leal","score_risco_churn":0.3,"acoes_recomendadas":["a","b"],"canal_preferencial":"SMS","urgencia":"Alta"}'


def test_answers(spark):
    cases = {
        GOOD: None,
        f"  {GOOD}\n": None,
        f"{GOOD} obrigado": "JSON inválido",
        f"{GOOD},{GOOD}": "JSON inválido",
        f"{GOOD} {{}}": "JSON inválido",
        f"{GOOD},": "JSON inválido",
        GOOD[:40]: "JSON inválido",
        "": "JSON inválido",
        "[1]": "JSON inválido",
        GOOD.replace("Leal", "Outro"): "segmento desconhecido",
        GOOD.replace("0.3", "1.2"): "score fora de 0-1",
        GOOD.replace("0.3", '"alto"'): "score_risco_churn ausente",
        GOOD.replace(',"urgencia":"Alta"', ""): "urgencia ausente",
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "a string")
    got = {r.a: r.problem for r in P.parse_answers(df, "a").collect()}
    assert got.pop(None) == "JSON inválido"
    assert got == cases
    answer = P.parse_answers(df, "a").filter(F.col("problem").isNull()).first().answer
    assert answer.acoes_recomendadas == ["a", "b"] and answer.score_risco_churn == 0.3


def test_render_leaves_braces_in_values(spark):
    df = spark.createDataFrame([("{b}", None)], "a string, b string")
    assert df.select(P.render("<{a}|{b}|{c}>", {"a": "a", "b": "b"})).first()[0] == "<{b}||{c}>"


def test_few_shot_is_balanced_and_not_joined(spark):
    pool = spark.createDataFrame([(i, "pos" if i < 8 else "neg", f"t{i}") for i in range(10)], "id long, label string, text string")
    picked = P.pick_examples(pool, "label", [F.asc("id")], 2)
    assert rows(picked, "id") == [(0,), (1,), (8,), (9,)]
    items = spark.createDataFrame([(1, "novo")], "n long, text string")
    got = P.few_shot(items, picked, 3, "Tarefa", "text", "label", ["turn", "label"], "Rótulo")
    text = got.first().prompt
    assert text.index('"t8"') < text.index('"t0"') < text.index('"t9"') < text.index('"novo"')
    assert "t1" not in text and text.endswith("Rótulo:")
    assert "NestedLoop" not in plan_of(got)
    bare = P.few_shot(items, picked.limit(0), 3, "Tarefa", "text", "label", ["turn", "label"], "Rótulo")
    assert "novo" in bare.first().prompt


def test_roles_and_layout(spark):
    df = spark.createDataFrame([("oi",)], "prompt string")
    assert [tuple(m) for m in P.with_role(df, "papel").first().messages] == [("system", "papel"), ("user", "oi")]
    assert '"segmento": "<Campeao|' in P.answer_layout()

