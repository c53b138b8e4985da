"""The Spanish stemmer against fixed pairs and a plain statement of it over all words of the documents."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tessera.functions import text as tx
from tessera.functions.stem import spanish_stem
from tessera.operators import vocabulary as vc

PAIRS = """cheque chequ  cheques chequ  chequera chequer  cheso ches  chetumaleños chetumaleñ  chía chi  chi chi  chiapaneca chiapanec
chiapanecas chiapanec  chiapaneco chiapanec  chiapas chiap  chiba chib  chic chic  chica chic  chicago chicag  chicharrones chicharron
chichimecas chichimec  chicles chicl  torá tor  tórax torax  torcer torc  toreado tor  toreados tor  toreándolo tor  torear tor  toreara tor
torearlo tor  toreó tore  torero torer  toreros torer  torio tori  tormenta torment  tornado torn  tornen torn  torneo torne  torneos torne
tornillos tornill  torniquete torniquet  toronto toront  torpedearon torped  torpeza torpez  torrencial torrencial  torrenciales torrencial
torreón torreon  torres torr  haciéndola hac  nacionalidad nacional  abundantemente abund  biología biolog
absolutamente absolut  posibilidad posibil  negativamente negat  instituciones institu  solución solucion  presencia presenci  frecuencias frecuenci  lleguen lleg
sigue sig  contribuyeron contribu  contribuyó contribu  oyó oyo  el el  y y""".split()


# ------------------------------------------------------------------ plain statement
V = "aeiouáéíóúü"
PRONOUN = "me se sela selo selas selos la le lo las les los nos".split()
GERUND = "iéndo ándo ár ér ír ando iendo yendo ar er ir".split()
PLAIN = ("anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas amiento amientos imiento imientos").split()
IC = "adora ador ación acion adoras adores aciones ante antes ancia ancias".split()
Y = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
SHORT = "en es éis emos".split()
VERBS = ("arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería eréis eríamos eremos erá eré "
         "irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada ida ía ara iera ad ed id ase iese aste iste an aban ían aran "
         "ieran asen iesen aron ieron ado ido ando iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais "
         "aseis ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos").split()


def longest(text, endings):
    return max((x for x in endings if text.endswith(x)), key=len, default="")


def marks(w):
    def after(at):
        for i in range(at + 1, len(w)):
            if w[i - 1] in V and w[i] not in V:
                return i + 1
        return len(w)

    r1 = after(0)
    rv = len(w)
    if len(w) > 2:
        if w[1] not in V:
            rv = next((i + 1 for i in range(2, len(w)) if w[i] in V), len(w))
        elif w[0] in V:
            rv = next((i + 1 for i in range(2, len(w)) if w[i] not in V), len(w))
        else:
            rv = 3
    return r1, after(r1), rv


def bare(text):
    return text.translate(str.maketrans("áéíóú", "aeiou"))


def step1(w, r1, r2):
    every = {**{x: "plain" for x in PLAIN}, **{x: "ic" for x in IC}, "logía": "log", "logías": "log", "ución": "u", "uciones": "u",
             "encia": "ente", "encias": "ente", "amente": "amente", "mente": "mente", "idad": "idad", "idades": "idad",
             **{x: "at" for x in ("iva", "ivo", "ivas", "ivos")}}
    end = longest(w, every)
    if not end:
        return None
    kind, head = every[end], w[:-len(end)]
    if len(head) < (r1 if kind == "amente" else r2):
        return None

    def drop(h, *endings):
        x = longest(h, endings)
        return h[:-len(x)] if x and len(h) - len(x) >= r2 else h

    if kind in ("log", "u", "ente"):
        return head + kind
    if kind == "amente":
        less = drop(head, "iv")
        return drop(less, "at") if less != head else drop(head, "os", "ic", "ad")
    return drop(head, *{"plain": [], "ic": ["ic"], "mente": ["ante", "able", "ible"], "idad": ["abil", "ic", "iv"], "at": ["at"]}[kind])


def stem(word):
    w = word.lower()
    r1, r2, rv = marks(w)
    pronoun = longest(w, PRONOUN)
    if pronoun:
        head = w[:-len(pronoun)]
        verb = longest(head, GERUND)
        if verb and len(head) - len(verb) >= rv and (verb != "yendo" or head.endswith("uyendo")):
            w = head[:-len(verb)] + bare(verb)
    done = step1(w, r1, r2)
    if done is None:
        end = longest(w[rv:], Y)
        if end and w[:-len(end)].endswith("u"):
            done = w[:-len(end)]
        else:
            end = longest(w[rv:], VERBS + SHORT)
            done = w[:len(w) - len(end)]
            if end in SHORT and done.endswith("gu"):
                done = done[:-1]
    end = longest(done[rv:], ["os", "a", "o", "á", "í", "ó", "e", "é"])
    done = done[:len(done) - len(end)]
    if end in ("e", "é") and done.endswith("gu") and len(done) - 1 >= rv:
        done = done[:-1]
    return bare(done)


def test_fixed_pairs(spark):
    pairs = list(zip(PAIRS[::2], PAIRS[1::2]))
    assert [(w, stem(w)) for w, _ in pairs] == pairs
    got = spark.createDataFrame(pairs, "w string, s string").select("w", spanish_stem("w").alias("s")).collect()
    assert sorted(map(tuple, got)) == sorted(pairs)


def test_made_up_words(spark):
    rng = random.Random(4)
    ends = [*PRONOUN, *GERUND, *PLAIN, *IC, *Y, *SHORT, *VERBS, "logía", "ución", "uciones", "encias", "amente", "mente", "idad", "ivas", "e", "é", "os"]
    words = {"".join(rng.choices("bcdgnrsu" + "aeiouáéü", k=rng.randrange(0, 7))) + "".join(rng.choices(
        [*ends, "iv", "at", "ic", "abil", "gu", "u", "ad", "os"], k=rng.randrange(0, 4))) for _ in range(6000)} | {"", "é", "LLEGUÉ", "üü", "ñandú"}
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(4).select("w", spanish_stem("w").alias("s"))
    wrong = [(r["w"], r["s"], stem(r["w"])) for r in df.collect() if r["s"] != stem(r["w"])]
    assert not wrong, wrong[:10]
    assert spark.createDataFrame([(None,)], "w string").select(spanish_stem("w")).first()[0] is None


def test_all_words_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", tx.tokenize(tx.clean_text("text")).alias("tokens"))
    df = vc.vocabulary(vc.explode_tokens(docs, "doc_id", "tokens")).select("token", spanish_stem("token").alias("s"))
    rows = df.collect()
    assert len(rows) > 1000 and [r for r in rows if r["s"] != stem(r["token"])] == []


@pytest.mark.parametrize("mode,want", [("stem", "torer torment gat"), ("both", "torer torment gat"), ("lemmatize", "toreros tormenta gato")])
def test_modes_without_a_stemmer_of_the_caller(spark, mode, want):
    df = spark.createDataFrame([(1, ["toreros", "tormenta", "gatos"])], "id long, tokens array<string>")
    lemmas = spark.createDataFrame([("gatos", "gato")], "token string, lemma string")
    assert vc.normalise_tokens(df, "tokens", "norm", lemmas, mode=mode).select(F.array_join("norm", " ")).first()[0] == want
    if mode == "both":
        assert vc.normalise_tokens(df, "tokens", "norm", mode=mode).select(F.array_join("norm", " ")).first()[0] == want


def test_own_stems_are_made_once_for_all_modes(spark):
    vocab = spark.createDataFrame([("torres",), ("gatos",), ("y",)], "token string")
    lemmas = spark.createDataFrame([("gatos", "gato")], "token string, lemma string")
    made = vc.normalisation_map(vocab, {"s": "stem", "b": "both"}, lemmas)
    plan, one = (df._jdf.queryExecution().optimizedPlan().toString() for df in (made, vocab.select(spanish_stem("token"))))
    assert plan.count("amente") <= 2 * one.count("amente")  # in the filter and the column: stems of lemmas only
    assert {tuple(r) for r in made.collect()} == {("torres", "torr", "torr"), ("gatos", "gat", "gat")}


def test_tokens_are_replaced_by_the_changes_of_their_own_row(spark):
    rows = spark.createDataFrame([(1, ["a", "b", None, "a", "cats"]), (1, ["b", "cats", "b"]), (2, None), (None, []), (3, ["zz"]), (4, [None, "cats"])], "id int, t array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("b", "B"), ("q", "r")], "token string, lemma string")
    out = vc.normalise_modes(rows, "t", {"l": "lemmatize", "x": "both", "y": "basic"}, lemmas)
    got = {(r["id"], tuple(r["t"]) if r["t"] is not None else None): (r["l"], r["x"], r["y"]) for r in out.collect()}
    assert got == {
        (1, ("a", "b", None, "a", "cats")): (["a", "B", None, "a", "cat"], ["a", "b", None, "a", "cat"], ["a", "b", None, "a", "cats"]),
        (1, ("b", "cats", "b")): (["B", "cat", "B"], ["b", "cat", "b"], ["b", "cats", "b"]),
        (2, None): (None, None, None), (None, ()): ([], [], []), (3, ("zz",)): (["zz"], ["zz"], ["zz"]),
        (4, (None, "cats")): ([None, "cat"], [None, "cat"], [None, "cats"])}
    assert "ArrowEvalPython" in out._jdf.queryExecution().executedPlan().toString()  # no lookup word by word in lambdas
    twice = lemmas.unionByName(spark.createDataFrame([("cats", "dog")], "token string, lemma string"))
    with pytest.raises(Exception, match="several entries"):
        vc.normalise_modes(rows, "t", {"l": "lemmatize"}, twice).collect()


@pytest.mark.parametrize("words", [200_000, 0])
def test_the_token_stream_is_not_the_side_that_every_task_gets(spark, monkeypatch, words):
    monkeypatch.setattr(vc, "MAP_BROADCAST", words)
    rows = spark.createDataFrame([(i, ["cats", f"w{i}", "b", "cats", None]) for i in range(50)], "id int, t array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("w7", "seven")], "token string, lemma string")
    out = vc.normalise_tokens(rows, "t", "n", lemmas)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate explode") == 1
    hit = [x for x in plan.splitlines() if "Join [token" in x]
    assert hit and all("BroadcastHashJoin" in x and "BuildRight" in x if words else "SortMergeJoin" in x for x in hit)
    assert {r["id"]: r["n"] for r in out.collect()} == {i: ["cat", "seven" if i == 7 else f"w{i}", "b", "cat", None] for i in range(50)}
