"""The lexical model: tables, enumerations and relation types."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the data model: part-of-speech codes, relation types and their inverses, resource metadata.
POS = ("NOUN", "VERB", "ADJ", "ADV", "CONJ", "ADP", "NREF", "UNK")
POS_OF_CODE = {"n": "NOUN", "v": "VERB", "a": "ADJ", "r": "ADV", "s": "ADJ", "c": "CONJ", "p": "ADP", "x": "NREF", "u": "UNK"}
SENSE_TYPES = ("antonym", "derivation", "pertainym", "participle")
CONCEPT_TYPES = ("hypernym", "instance_hypernym", "mero_member", "mero_part", "mero_substance", "causes", "entails", "antonym")
SENSE_INVERSES = {t: t for t in SENSE_TYPES}
CONCEPT_INVERSES = {
    "hypernym": "hyponym",
    "instance_hypernym": "instance_hyponym",
    "mero_member": "holo_member",
    "mero_part": "holo_part",
    "mero_substance": "holo_substance",
    "antonym": "antonym",
    "causes": "is_caused_by",
    "entails": "is_entailed_by",
}
ISA_TYPES = ("hypernym", "instance_hypernym")
SAME_CATEGORY_TYPES = ("hypernym", "instance_hypernym", "mero_member", "mero_part", "mero_substance", "causes", "entails")
#: Relations whose inverse a source may state instead; a relation paired with itself is symmetric.
SOURCE_CONCEPT_PAIRS = CONCEPT_INVERSES | {"similar": "similar", "attribute": "attribute", "eq_synonym": "eq_synonym", "ir_synonym": "ir_synonym", "also": None}
SOURCE_SENSE_PAIRS = {"antonym": "antonym", "derivation": "derivation", "also": "also", "similar": "similar", "pertainym": None, "participle": None}
STANDARD_CONCEPT_TYPES = (
    "hypernym", "hyponym", "instance_hypernym", "instance_hyponym", "mero_member", "holo_member", "mero_part", "holo_part", "mero_substance", "holo_substance", "antonym",
    "similar", "also", "attribute", "causes", "is_caused_by", "entails", "is_entailed_by", "domain_topic", "has_domain_topic", "domain_region", "has_domain_region",
    "domain_usage", "has_domain_usage", "state",
)
STANDARD_SENSE_TYPES = (
    "antonym", "derivation", "pertainym", "participle", "also", "similar", "state", "domain_topic", "has_domain_topic", "domain_region", "has_domain_region", "domain_usage",
    "has_domain_usage", "exemplifies", "is_exemplified_by",
)
DIRECTED_TYPES = (
    "hypernym", "hyponym", "instance_hypernym", "instance_hyponym", "mero_member", "holo_member", "mero_part", "holo_part", "mero_substance", "holo_substance", "causes",
    "is_caused_by", "entails", "is_entailed_by",
)
RESOURCE_ATTRIBUTES = ("id", "version", "label", "language", "url", "citation", "license", "email", "status", "confidenceScore")
IMPLICIT_RESOURCES = {
    "pwn": {
        "version": "3.0", "label": "Princeton WordNet", "language": "en", "url": "https://wordnet.princeton.edu/", "licence": "wordnet",
        "citation": "Christiane Fellbaum (Ed.) 1998 WordNet: An electronic lexical database. MIT Press.",
    },
}
CILI = {
    "code": "cili", "version": "1.0", "label": "Collaborative Interlingual Index (CILI)", "url": "https://github.com/globalwordnet/cili",
    "licence": "https://creativecommons.org/licenses/by/4.0/",
}

SCHEMAS = {
    "relation_types": "id long, type string",
    "languages": "id long, code string, name string",
    "synsets": "id long, ili string, pos string",
    "entries": "id long, language_id long, pos string",
    "forms": "id long, entry_id long, form string, norm string, rank int",
    "pronunciations": "id long, form_id long, variety string, pron string",
    "senses": "id long, entry_id long, synset_id long, sense_index int",
    "definitions": "id long, synset_id long, definition string, language_id long",
    "synset_relations": "id long, source long, target long, type string",
    "sense_relations": "id long, source long, target long, type string",
    "examples": "id long, example string",
    "sense_examples": "sense_id long, example_id long",
    "definition_annotations": "definition_id long, start int, end int, sense_id long",
    "example_annotations": "example_id long, start int, end int, sense_id long",
    "resources": "code string, version string, label string, language string, url string, citation string, licence string, email string, status string, confidence_score double, extra string, synset_count long, sense_count long",
    "arasaac": "synset_id long, arasaac_id long",
    "provenance": "table_name string, item_id long, resource string, version string, original_id string",
}


@dataclass
class Lexicon:
    """One DataFrame per table of SCHEMAS; tables that were not given are empty."""

    tables: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(name) from None

    def with_(self, **tables: DataFrame) -> Lexicon:
        return replace(self, tables=self.tables | tables)

    @staticmethod
    def of(spark: SparkSession, **tables: DataFrame) -> Lexicon:
        return Lexicon({n: tables.get(n, spark.createDataFrame([], s)) for n, s in SCHEMAS.items()})

    @staticmethod
    def load(spark: SparkSession, root: str) -> Lexicon:
        return Lexicon({n: spark.read.schema(s).parquet(f"{root}/{n}") for n, s in SCHEMAS.items()})

    #: Tables that are joined on these columns are bucketed by them, alike.
    BUCKETS = {"forms": "entry_id", "entries": "id", "senses": "entry_id", "synsets": "id", "definitions": "synset_id"}

    def register(self, database: str, buckets: int = 16) -> None:
        """Save as catalogue tables with statistics. Forms, entries and senses share their bucketing by entry, so that the
        joins of a search need no shuffle; so do synsets and definitions."""
        spark = self.synsets.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name, df in self.tables.items():
            key = self.BUCKETS.get(name)
            writer = df.write if key is None else df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
            writer.mode("overwrite").saveAsTable(f"{database}.{name}")
            spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS FOR ALL COLUMNS")

    @staticmethod
    def registered(spark: SparkSession, database: str) -> Lexicon:
        return Lexicon({n: spark.table(f"{database}.{n}") for n in SCHEMAS})

    def save(self, root: str) -> None:
        """Forms are sorted by their normalised form, so that searches prune row groups by its minimum and maximum."""
        for name, df in self.tables.items():
            if name == "forms":
                df = df.repartitionByRange(max(1, df.rdd.getNumPartitions()), "norm").sortWithinPartitions("norm")
            elif name == "provenance":
                df.write.mode("overwrite").partitionBy("table_name").parquet(f"{root}/{name}")
                continue
            df.write.mode("overwrite").parquet(f"{root}/{name}")
