"""The stages from raw reviews to the final table, and a thin command line.

``python -m millrace.plans.stages run-full --root DIR --out DIR --products NAME=FILE ...``; other
verbs are ``run-step N``, ``run-until N`` and ``coverage-report``. Each stage reads the
checkpoint before it, writes its own, and sets suspects aside for people. What people have
checked comes back with ``--checked NAME=FILE`` (``advertising``, ``foreign``, ``short``,
``terms``, ``spelling``, ``near_duplicates``); without it the rows set aside stay out.
``--lexicon DIR`` holds the word tables under the names of ``LEXICON_FILES``; each is
optional. Every field of ``Settings`` is a flag.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession

from ..operators import coarse, context_models, lexical, neardup, normalize, structure
from ..operators.review import apply_spelling_review, in_order, merge_checked_rows
from ..schema import TEXT_NORM
from ..sources.lexicons import Lexicon, read_lexicon
from ..sources.tables import Products, path_exists, read_checked, read_checkpoint, read_model_cache, read_products, write_checkpoint, write_suspects
from .registry import StepRegistry


@dataclass
class Settings:
    most_short_words: int = 4
    similarity: float = 0.9
    least_foreign_share: float = 0.95
    least_criterion_rows: int = 3
    feed_lexical_to_final: bool = False
    least_votes: int = lexical.MIN_VOTES
    expand_abbreviations: bool = False  # before stage 6, with rows of doubtful terms and of spelling errors set aside
    products: list[str] = field(default_factory=list)
    checked: dict[str, DataFrame] = field(default_factory=dict)  # reviewed rows by the name under which they were set aside
    models: dict[str, Callable[[], context_models.ContextModel]] = field(default_factory=dict)  # loaders by source: lexical.SPELLER, lexical.ACCENTER
    caches: dict[str, DataFrame] = field(default_factory=dict)  # earlier outputs (in, out) by source


def back(split: coarse.Split, name: str, settings: Settings) -> DataFrame:
    """The kept rows and those that a review has approved."""
    return merge_checked_rows(*split, settings.checked.get(name), settings.products, name)


REGISTRY = StepRegistry()
Aside = dict[str, DataFrame]


@REGISTRY.step("0", 0, "prepare", "stable ids and a copy of the raw content")
def prepare(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    return structure.assign_review_id(df), {}


@REGISTRY.step("1", 1, "structure", "misplaced fields, empty rows, types, criteria")
def repair(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    df = structure.fix_data_types(structure.drop_empty_rows(structure.fix_field_misalignment(df)))
    return structure.split_merged_fields(df, least_rows=settings.least_criterion_rows), {}


@REGISTRY.step("2", 1, "normalize", "Unicode, HTML, spaces, lower-cased copy")
def normalise(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    return normalize.add_text_norm(normalize.strip_extra_whitespace(normalize.normalize_unicode_and_html(df))), {}


@REGISTRY.step("3", 2, "coarse_filter", "exact duplicates, noise, advertising, other languages")
def coarse_filter(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    evidence = coarse.duplicate_evidence(df)
    df = coarse.drop_exact_duplicates_across(coarse.drop_exact_duplicates(df))
    adverts = coarse.split_advertising(coarse.drop_symbol_only(df))
    foreign = coarse.split_foreign(back(adverts, "advertising", settings), least_share=settings.least_foreign_share)
    return back(foreign, "foreign", settings), {"duplicates": evidence.withColumnRenamed("source", "product"), "advertising": adverts.suspect, "foreign": foreign.suspect}


@REGISTRY.step("4", 2, "char_noise", "emoji, special characters, repeats")
def char_noise(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    df = normalize.remove_meaningless_special_chars(normalize.handle_inline_emoji(df, lexicon.emoji))
    return normalize.add_text_norm(normalize.strip_extra_whitespace(normalize.normalize_repeated_characters(df))), {}


@REGISTRY.step("5", 2, "short_filter", "reviews of few words")
def short_filter(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    short = coarse.split_short(df, most_words=settings.most_short_words)
    return back(short, "short", settings), {"short": short.suspect}


@REGISTRY.step("6", 3, "lexical", "non-standard tokens: votes and replacements in new columns")
def lexical_stage(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    aside: Aside = {}
    if settings.expand_abbreviations:
        terms = lexical.split_doubtful_terms(lexical.normalize_abbreviations(df, lexicon), lexicon)
        spelling = lexical.split_spelling_errors(back(terms, "terms", settings), lexicon)
        df = apply_spelling_review(*spelling, settings.checked.get("spelling"), settings.products)
        aside |= {"terms": terms.suspect, "spelling": spelling.suspect}
    stats = lexical.token_stats(df, lexicon)
    nonstandard = lexical.nonstandard_tokens(stats, lexicon)
    suspects, contexts = with_models(lexical.suspect_rows(df, nonstandard), settings)
    values = lexical.corrected_values(lexical.suspect_values(df, nonstandard), least_votes=settings.least_votes)
    out = lexical.apply_corrections(df, suspects, lexicon, contexts, least_votes=settings.least_votes)
    changes = lexical.change_counts(out, values)
    table = lexical.frequency_table(suspects, stats, lexicon, contexts)
    aside |= {
        "tokens": lexical.annotate_suggestions(suspects, lexicon, contexts),
        "token_list": lexical.list_nonstandard(df, nonstandard),
        "token_frequencies": table,
        "token_kinds": lexical.kind_summary(table),
        "criterion_values": lexical.annotate_suggestions(values, lexicon),
        "changes": changes,
    }
    return lexical.apply_value_corrections(out, values), aside


def with_models(suspects: DataFrame, settings: Settings) -> tuple[DataFrame, dict[str, str]]:
    """suspects with a column of suggestions for each model that is given, and these columns by source."""
    contexts = {}
    for source, run, column in ((lexical.SPELLER, context_models.speller_context, "speller"), (lexical.ACCENTER, context_models.accent_context, "accenter")):
        if source in settings.models:
            suspects = run(suspects, settings.models[source], settings.caches.get(source), name=column)
            contexts[source] = column
    return suspects, contexts


@REGISTRY.step("7", 4, "final_dedup", "near-duplicates within and across products, final check")
def final_dedup(df: DataFrame, lexicon: Lexicon, settings: Settings) -> tuple[DataFrame, Aside]:
    within = neardup.split_near_duplicates(df, TEXT_NORM, threshold=settings.similarity)
    df, across = neardup.split_cross_file_near_duplicates(back(within, "near_duplicates", settings), settings.similarity)
    df = structure.drop_empty_rows(df)
    return coarse.final_check(df, df.count()), {"near_duplicates": within.suspect, "cross_file": across}


@dataclass(frozen=True)
class Stage:
    version: str
    step: str  # in the registry
    source: str | None  # version that it reads; None: the raw tables
    manual_review: bool = False


STAGES = [
    Stage("v0_raw", "0", None),
    Stage("v1_structured", "1", "v0_raw"),
    Stage("v2_normalized", "2", "v1_structured"),
    Stage("v3_filtered", "3", "v2_normalized", True),
    Stage("v4_char_cleaned", "4", "v3_filtered"),
    Stage("v5_length_filtered", "5", "v4_char_cleaned", True),
    Stage("v6_lexical", "6", "v5_length_filtered", True),
    Stage("v7_final", "7", "v5_length_filtered", True),
]


def run_stage(spark: SparkSession, number: int, products: Products, out: str, lexicon: Lexicon, settings: Settings | None = None) -> DataFrame | None:
    settings = settings or Settings()
    settings.products = settings.products or products.names()
    stage = STAGES[number]
    source = "v6_lexical" if stage.version == "v7_final" and settings.feed_lexical_to_final else stage.source
    df = read_products(spark, products) if source is None else read_checkpoint(spark, out, source, "all")
    if df is None:
        return None
    result, aside = REGISTRY.get(stage.step)(df, lexicon, settings)
    done = write_checkpoint(result, out, stage.version, "all")
    for name, rows in aside.items():
        write_suspects(rows, out, f"{stage.version}_{name}")
    return done


def run_until(spark: SparkSession, last: int, products: Products, out: str, lexicon: Lexicon, settings: Settings | None = None) -> DataFrame | None:
    df = None
    for k in range(last + 1):
        df = run_stage(spark, k, products, out, lexicon, settings)
    return df


def chain(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Steps as one lazy plan."""

    def run(df: DataFrame) -> DataFrame:
        for s in steps:
            df = df.transform(s)
        return df

    return run


#: Names of the word tables in a lexicon folder, by the field of ``Lexicon`` that they fill.
LEXICON_FILES = {
    "abbreviations": "abbreviations.tsv",
    "suspect_terms": "suspect_terms.txt",
    "spelling_errors": "spelling_errors.tsv",
    "whitelist": "whitelist.txt",
    "emoji": "emoji.txt",
    "syllables": "syllables.dic",
    "norms": "norms.csv",
    "english": "english.txt",
}
_FLAGS = [f for f in fields(Settings) if f.type in ("int", "float", "bool")]


def _pairs(texts: list[str]) -> dict[str, str]:
    return dict(x.split("=", 1) for x in texts)


def read_lexicon_folder(spark: SparkSession, folder: str | None) -> Lexicon:
    paths = {k: f"{folder}/{name}" for k, name in LEXICON_FILES.items()} if folder else {}
    return read_lexicon(spark, **{k: p for k, p in paths.items() if path_exists(spark, p)})


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="millrace", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("verb", choices=["run-step", "run-until", "run-full", "coverage-report"])
    p.add_argument("number", nargs="?", type=int, default=len(STAGES) - 1)
    p.add_argument("--root")
    p.add_argument("--out")
    p.add_argument("--products", nargs="*", default=[], metavar="NAME=FILE")
    p.add_argument("--lexicon", metavar="DIR")
    p.add_argument("--checked", nargs="*", default=[], metavar="NAME=FILE")
    p.add_argument("--model-cache", nargs="*", default=[], metavar="SOURCE=FILE")
    for f in _FLAGS:
        kind = {"action": argparse.BooleanOptionalAction} if f.type == "bool" else {"type": {"int": int, "float": float}[f.type]}
        p.add_argument("--" + f.name.replace("_", "-"), default=f.default, **kind)
    a = p.parse_args(arguments)
    if a.verb == "coverage-report":
        for s in STAGES:
            print(f"{s.version}: step {s.step}, {'review by people' if s.manual_review else 'automatic'}")
        return
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    products = Products(a.root, _pairs(a.products))
    settings = Settings(**{f.name: getattr(a, f.name) for f in _FLAGS}, products=products.names())
    settings.checked = {k: read_checked(spark, path, settings.products) for k, path in _pairs(a.checked).items()}
    for source, path in _pairs(a.model_cache).items():  # earlier outputs of a model stand in for it
        settings.caches[source] = read_model_cache(spark, path)
        settings.models[source] = context_models.no_model
    run = run_stage if a.verb == "run-step" else run_until
    df = run(spark, len(STAGES) - 1 if a.verb == "run-full" else a.number, products, a.out, read_lexicon_folder(spark, a.lexicon), settings)
    if df is not None:
        in_order(df).show(20)


if __name__ == "__main__":
    main()
