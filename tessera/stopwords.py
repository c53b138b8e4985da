"""Standard Spanish stopword list.

The function words are fixed values; the forms of the auxiliary verbs follow
from their stems and the regular endings, so they are built by rule.
"""

from __future__ import annotations

# --- fixed values: Spanish function words, in the standard list's order -------
FUNCTION_WORDS = """
de la que el en y a los del se las por un para con no una su al lo como más
pero sus le ya o este sí porque esta entre cuando muy sin sobre también me
hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese
eso ante ellos e esto mí antes algunos qué unos yo otro otras otra él tanto
esa estos mucho quienes nada muchos cual poco ella estar estas algunas algo
nosotros mi mis tú te ti tu tus ellas nosotras vosostros vosostras os mío mía
míos mías tuyo tuya tuyos tuyas suyo suya suyos suyas nuestro nuestra nuestros
nuestras vuestro vuestra vuestros vuestras esos esas
""".split()

# --- fixed values: irregular verb forms ----------------------------------------
IRREGULAR_FORMS = """
estoy estás está estamos estáis están esté estés estemos estéis estén
estaba estabas estábamos estabais estaban
he has ha hemos habéis han haya hayas hayamos hayáis hayan
soy eres es somos sois son sea seas seamos seáis sean
era eras éramos erais eran fui fuiste fue fuimos fuisteis fueron
tengo tienes tiene tenemos tenéis tienen tenga tengas tengamos tengáis tengan
sintiendo sentido sentida sentidos sentidas siente sentid estad tened
""".split()

# --- fixed values: stems and endings --------------------------------------------
FUTURE_STEMS = ["estar", "habr", "ser", "tendr"]
FUTURE_ENDINGS = ["é", "ás", "á", "emos", "éis", "án"]
CONDITIONAL_ENDINGS = ["ía", "ías", "íamos", "íais", "ían"]
IMPERFECT_STEMS = ["hab", "ten"]
PRETERITE_STEMS = ["estuv", "hub", "tuv"]
PRETERITE_ENDINGS = ["e", "iste", "o", "imos", "isteis", "ieron"]
SUBJUNCTIVE_ENDINGS = ["era", "eras", "éramos", "erais", "eran", "ese", "eses", "ésemos", "eseis", "esen"]
PARTICIPLE_STEMS = {"est": "a", "hab": "i", "ten": "i"}
PARTICIPLE_ENDINGS = ["do", "da", "dos", "das"]


def spanish_standard() -> tuple[str, ...]:
    """Function words followed by the verb forms, without repeats."""
    verbs = [s + e for s in FUTURE_STEMS for e in FUTURE_ENDINGS + CONDITIONAL_ENDINGS]
    verbs += [s + e for s in IMPERFECT_STEMS for e in CONDITIONAL_ENDINGS]
    verbs += [s + e for s in PRETERITE_STEMS for e in PRETERITE_ENDINGS]
    verbs += [s + "i" + e for s in PRETERITE_STEMS for e in SUBJUNCTIVE_ENDINGS]
    verbs += ["fu" + e for e in SUBJUNCTIVE_ENDINGS]
    verbs += [s + v + e for s, v in PARTICIPLE_STEMS.items() for e in PARTICIPLE_ENDINGS]
    verbs += [s + ("a" if v == "a" else "ie") + "ndo" for s, v in PARTICIPLE_STEMS.items()]
    return tuple(dict.fromkeys(FUNCTION_WORDS + IRREGULAR_FORMS + verbs))
