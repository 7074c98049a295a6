"""Analyzers of single languages as Columns: folding of letters, elided articles, stop words, and light stemming.

A stemmer here takes one ending off, and in a few languages one beginning, where enough of the word is left. Stop words
are the caller's: whole lists are data (read_stop_words reads the usual files), not code.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{M}\p{N}_']+"


@dataclass(frozen=True)
class Language:
    """fold: pairs of characters that are taken for one another, one by one. drop: characters left out. endings and
    beginnings: taken off, the longest first, if at least so many characters are left. elided: an article written onto
    the word. pairs: written without spaces, so overlapping pairs of characters stand for words."""

    endings: str = ""
    least: int = 3
    beginnings: str = ""
    fold: tuple[str, str] = ("", "")
    drop: str = ""
    elided: str = ""
    pairs: str = ""
    widen: tuple[tuple[str, str], ...] = ()


_ROMANCE = ("àáâãäçèéêëìíîïñòóôõöùúûü", "aaaaaceeeeiiiinooooouuuu")
_FRENCH, _ITALIAN, _CATALAN, _IRISH = "l m t qu n s j d c jusqu quoiqu lorsqu puisqu", "c l all dall dell nell sull coll pell gl agl dagl degl negl sugl un m t s v d", "d l m n s t", "d m b"
#: Endings by language, in the order of the alphabet of their names: a choice of the commonest inflections.
LANGUAGES: dict[str, Language] = {
    "ar": Language("ها ان ات ون ين يه ية ه ة ي", 2, "وال بال كال فال لل ال و", ("أإآىة", "اااىه"), "ـًٌٍَُِّْ"),
    "bg": Language("овете ищата овци ите ища ият ове ета ата ото ът ят та то те ия ци ни а я о е и"),
    "ca": Language("acions aments itats ament ció itat osos oses ives ius es os as en s a o e", fold=_ROMANCE, elided=_CATALAN),
    "cz": Language("ětem atům ětech atech ech ového ovému ými ami emi ové ách ích ého ému ému ým ům ou ě a e i o u y á é í ů", 3),
    "da": Language("erendes hedens ernes erens endes erede hedes ernes heden eren erne enes eres ende heds es en er et ene e s"),
    "de": Language("ern em er en es e s n", 4, fold=("äöü", "aou"), widen=(("ß", "ss"),)),
    "el": Language("ιους ματα ματων ους ων ου ος οι ες ης ας εις α η ο ε ι υ", 3, fold=("άέήίόύώϊϋΐΰς", "αεηιουωιυιυσ")),
    "en": Language(),
    "es": Language("aciones amientos imientos acion amente mente idades idad ivas ivos iva ivo oses es os as a o e s", fold=_ROMANCE),
    "eu": Language("arekin entzat aren ekin etan etik ak ek en an ra ko a"),
    "fa": Language("", fold=("يكةۀ", "یکهه"), drop="‌ًٌٍَُِّْ"),
    "fi": Language("issa issä ista istä illa illä ilta iltä ille iksi ina inä ssa ssä sta stä lla llä lta ltä lle ksi jen ien den tta ttä ia iä ja jä na nä an än en in on a ä n t", 3),
    "fr": Language("issements issement ements ement ations ation euses euse ives ive ites ite ments ment eaux aux ees ee es er ez eux ifs if e s", 3, fold=_ROMANCE, elided=_FRENCH, widen=(("œ", "oe"),)),
    "ga": Language("eanna anna acht eacht aí ibh igh í a e", fold=("áéíóú", "aeiou"), elided=_IRISH),
    "gl": Language("cions mente dades dade cion es os as a o e s", fold=_ROMANCE),
    "hi": Language("ियों ियाँ ाओं ाएँ ियां ों ें ाई ता ते ती ना नी ने ो े ू ु ी ि ा", 2, fold=("ँ", "ं"), drop="़‌‍"),
    "hu": Language("aitok eitek jaink jeink okat eket ökat ában ében ából ből ának ének ban ben ból ről nak nek val vel hoz hez höz nál nél tól től ok ek ök ak at et ot öt on en ön a e i k t", 3),
    "hy": Language("ություն ներին ներից ներով ներում ների ները ներ երին երից երով երի երը եր ում ից ով ին ի ը ն"),
    "id": Language("lah kah pun nya kan ku mu an i", 4, "meng meny peng peny men mem pen pem ber ter per di ke se me pe"),
    "it": Language("azioni azione amenti amento mente ità ivi iva ivo ive osi osa oso ose i e a o", fold=("", ""), elided=_ITALIAN),
    "ja": Language(pairs=r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー"),
    "lv": Language("ajiem ajām iem ajai ajam ām as am os us is ai ei ie es ēm a e i o u s š", 3),
    "nl": Language("heden ingen eren heid ing en er es e s", 3, fold=("äëïöüáéíóú", "aeiouaeiou")),
    "no": Language("hetenes hetene hetens heter heten endes ande ende edes enes erte ede ane ene ens ers ets het ast es en ar er as et a e s"),
    "pt": Language("acoes acao amentos amento mente idades idade ivas ivos iva ivo oes aes es os as a o e s", fold=_ROMANCE),
    "ro": Language("urilor iilor elor ilor urile ului atii atie uri ile lor ul ii ei le ea a e i u", fold=("şţ", "șț")),
    "ru": Language("ями ами ого его ому ему ыми ими иях ях ах ев ов ие ье еи ии ей ой ий ый ая яя ое ее ою ею ию ью ам ям ом ем ым им ые ия ья а е и й о у ы ь ю я", 3, fold=("ё", "е")),
    "sv": Language("heterna hetens heter heten anden andes arnas ernas ornas arens andet arna erna orna ande aste arne aren ades erns ade are ern ens het ast ad en ar er or as es at a e s"),
    "th": Language(pairs=r"\p{IsThai}"),
    "tr": Language("larının lerinin larında lerinde larına lerine ların lerin ları leri dan den tan ten lar ler nın nin nun nün da de ta te ın in un ün ım im ı i u ü a e", 2),
}


def _any_of(words: str) -> str:
    return "|".join(sorted(words.split(), key=lambda w: (-len(w), w)))


def stem_light(word: Column, language: str) -> Column:
    """The folded word without one beginning and one ending of the language, where enough is left."""
    known = LANGUAGES[language]
    out = word
    for wide, narrow in known.widen:
        out = F.replace(out, F.lit(wide), F.lit(narrow))
    if known.fold[0] or known.drop:
        out = F.translate(out, known.fold[0] + known.drop, known.fold[1])
    if known.beginnings:
        out = F.regexp_replace(out, f"^(?:{_any_of(known.beginnings)})(?=.{{{known.least}}})", "")
    if known.endings:
        # Both written forms of an ending count where folding changes it.
        folded = known.endings.translate(str.maketrans(*known.fold)) if known.fold[0] else known.endings
        out = F.regexp_replace(out, f"(?<=.{{{known.least}}})(?:{_any_of(folded)})$", "")
    return out


def analyze(text: Column, language: str, stop: Collection[str] = (), protected: Collection[str] = ()) -> Column:
    """The words of a text in the language as they are indexed: lower case, without elided articles and stop words,
    stemmed but for protected words. Null for null, an empty array for a text without words."""
    known = LANGUAGES[language]
    lower = F.lower(F.translate(text, "Iİ", "ıi")) if language == "tr" else F.lower(text)
    words = F.regexp_extract_all(lower, F.lit(f"([{known.pairs}]+|{WORD})" if known.pairs else f"({WORD})"), F.lit(1))
    if language == "tr":
        words = F.transform(words, lambda w: F.regexp_replace(w, "'.*$", ""))
    if known.elided:
        words = F.transform(words, lambda w: F.regexp_replace(w, f"^(?:{_any_of(known.elided)})'", ""))
    if language == "en":
        words = F.transform(words, lambda w: F.regexp_replace(w, "'s?$", ""))
    words = F.filter(words, lambda w: (w != "") & ~w.isin(sorted(stop)) if stop else w != "")
    if known.pairs:
        of = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - 1, F.lit(1))), lambda i: F.substring(w, i, F.lit(2)))
        return F.flatten(F.transform(words, lambda w: F.when(w.rlike(f"^[{known.pairs}]+$"), of(w)).otherwise(F.array(w))))
    if language == "en":
        from millrace.functions.analyzers import porter

        if not protected:
            return porter(words)
        return F.zip_with(words, porter(words), lambda w, s: F.when(w.isin(sorted(protected)), w).otherwise(s))
    kept = sorted(protected)
    return F.transform(words, lambda w: F.when(w.isin(kept), w).otherwise(stem_light(w, language)) if kept else stem_light(w, language))


def read_stop_words(spark: SparkSession, path: str) -> set[str]:
    """The words of a list: one or more a line, `|` and `#` begin a comment. Lists of stop words are short."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"[|#].*$", "").alias("line"))
    return {r[0] for r in lines.select(F.explode(F.split("line", r"\s+")).alias("word")).filter("word <> ''").select(F.lower("word")).distinct().collect()}


def minimal_english(word: Column) -> Column:
    """Plurals to singulars only."""
    ies = word.rlike("[^ae]ies$")
    es = word.rlike("(?:ss|sh|ch|x|zz)es$")
    return F.when(ies, F.concat(F.regexp_replace(word, "ies$", ""), F.lit("y"))).when(es, F.regexp_replace(word, "es$", "")).when(word.rlike("[^us]s$"), F.regexp_replace(word, "s$", "")).otherwise(word)


def split_words(text: Column, stop: Collection[str] = (), protected: Collection[str] = ()) -> Column:
    """text_en_splitting: words cut at case changes, digits and signs, and each whole; lower case, without stop words,
    stemmed."""
    from millrace.functions.analyzers import porter, word_parts

    words = F.filter(word_parts(text), lambda w: ~w.isin(sorted(stop)) if stop else F.lit(True))
    stems = porter(words)
    return F.zip_with(words, stems, lambda w, s: F.when(w.isin(sorted(protected)), w).otherwise(s)) if protected else stems


def split_words_tight(text: Column, stop: Collection[str] = ()) -> Column:
    """text_en_splitting_tight: each word with its parts run together, lower case, singular, each once."""
    whole = F.transform(F.split(F.trim(text), r"\s+"), lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")))
    kept = F.filter(whole, lambda w: (w != "") & ~w.isin(sorted(stop)) if stop else w != "")
    return F.array_distinct(F.transform(kept, minimal_english))


def money(value: Column, rates: DataFrame, to: str = "USD") -> Column:
    """`amount,CODE` (a bare amount is in the default currency) in another currency; null where the rate isn't known.
    rates (from, to, rate) are few: a table of exchange rates."""
    known = {(r["from"].upper(), r["to"].upper()): float(r["rate"]) for r in rates.collect()}
    factors = {code: rate for (code, goal), rate in known.items() if goal == to} | {code: 1 / rate for (goal, code), rate in known.items() if goal == to and (code, goal) not in known and rate} | {to: 1.0}
    parts = F.split(value, ",")
    code = F.upper(F.trim(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(to))))
    table = F.create_map(*[x for c, f in sorted(factors.items()) for x in (F.lit(c), F.lit(f))])
    return F.trim(F.try_element_at(parts, F.lit(1))).try_cast("double") * F.try_element_at(table, code)


#: Metaphone as a chain of replacements, in order: what English spelling says about the sound of a consonant.
_SOUNDS = [
    (r"[^A-Z]", ""), (r"([A-BD-Z])\1+", "$1"), (r"^(?:[GKP]N)", "N"), (r"^AE", "E"), (r"^WR", "R"), (r"^X", "S"), (r"^WH", "W"), (r"MB$", "M"), (r"SCH", "SK"), (r"CIA|CH", "X"), (r"SC(?=[IEY])", "S"), (r"C(?=[IEY])", "S"), (r"C", "K"),
    (r"DG(?=[EYI])", "J"), (r"D", "T"), (r"GH(?![AEIOU]|$)", ""), (r"GN(?:ED)?$", "N"), (r"G(?=[IEY])", "J"), (r"G", "K"), (r"(?<=[AEIOU])H(?![AEIOU])", ""), (r"CK", "K"), (r"PH", "F"), (r"Q", "K"), (r"S(?=I[OA])|SH", "X"),
    (r"T(?=I[AO])", "X"), (r"TH", "0"), (r"TCH", "X"), (r"V", "F"), (r"W(?![AEIOU])", ""), (r"(?<!^)X(?=$|[^A-Z])", "KS"), (r"Y(?![AEIOU])", ""), (r"Z", "S"), (r"(?<!^)[AEIOU]", ""), (r"(.)\1+", "$1"),
]


def phonetic(word: Column) -> Column:
    """What an English word sounds like, by Metaphone (Philips 1990); words that sound alike have the same."""
    out = F.upper(word)
    for pattern, sound in _SOUNDS:
        out = F.regexp_replace(out, pattern, sound)
    return out


def text_phonetic(text: Column) -> Column:
    """phonetic_en: the words of a text by their sound."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))
    return F.filter(F.transform(words, phonetic), lambda w: w != "")
