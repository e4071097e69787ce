"""Small tables written out in code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

TRANSLATION_SCHEMA = "EnglishValue string, SpanishValue string, FrenchValue string"

# Fixed values.
EDUCATION = [
    ("Bachelors", "Licenciatura", "Licence"),
    ("Partial College", "Estudios universitarios parciales", "Études universitaires partielles"),
    ("High School", "Educación secundaria", "Lycée"),
    ("Partial High School", "Educación secundaria parcial", "Lycée partiel"),
    ("Graduate Degree", "Título de posgrado", "Diplôme d'études supérieures"),
]
OCCUPATION = [
    ("Professional", "Profesional", "Professionnel"),
    ("Management", "Gestión", "Cadre"),
    ("Skilled Manual", "Trabajo manual cualificado", "Ouvrier qualifié"),
    ("Clerical", "Administrativo", "Employé de bureau"),
    ("Manual", "Trabajo manual", "Ouvrier"),
]


def lookup_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def education(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, EDUCATION, TRANSLATION_SCHEMA)


def occupation(spark: SparkSession) -> DataFrame:
    return lookup_table(spark, OCCUPATION, TRANSLATION_SCHEMA)
