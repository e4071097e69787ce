"""Customer dimension: current rows and history, from a change feed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.survey import survey_fields
from tidemark.operators.changes import post_images
from tidemark.operators.joins import DimSpec, star_join, translate
from tidemark.operators.scd2 import closed, current, load_stamp
from tidemark.operators.timeline import latest_per_key
from tidemark.operators.upsert import insert_if_absent, merge_upsert, restrict_to_keys

_ROOT = "//IndividualSurvey/"

# Survey fields, their node and type.
SURVEY = {
    "BirthDate": (_ROOT + "BirthDate", "date"),
    "MaritalStatus": (_ROOT + "MaritalStatus", "string"),
    "Gender": (_ROOT + "Gender", "string"),
    "YearlyIncome": (_ROOT + "YearlyIncome", "string"),
    "TotalChildren": (_ROOT + "TotalChildren", "int"),
    "NumberChildrenAtHome": (_ROOT + "NumberChildrenAtHome", "int"),
    "EnglishEducation": (_ROOT + "Education", "string"),
    "EnglishOccupation": (_ROOT + "Occupation", "string"),
    "HouseOwnerFlag": (_ROOT + "HomeOwnerFlag", "string"),
    "NumberCarsOwned": (_ROOT + "NumberCarsOwned", "int"),
    "CommuteDistance": (_ROOT + "CommuteDistance", "string"),
}
PERSON = {
    "Title": "title",
    "FirstName": "first_name",
    "MiddleName": "middle_name",
    "LastName": "last_name",
    "NameStyle": "name_style",
    "Suffix": "suffix",
}
ATTRIBUTES = [
    "GeographyKey", "CustomerAlternateKey", "Title", "FirstName", "MiddleName", "LastName",
    "NameStyle", "BirthDate", "MaritalStatus", "Suffix", "Gender", "EmailAddress", "YearlyIncome",
    "TotalChildren", "NumberChildrenAtHome", "EnglishEducation", "SpanishEducation",
    "FrenchEducation", "EnglishOccupation", "SpanishOccupation", "FrenchOccupation",
    "HouseOwnerFlag", "NumberCarsOwned", "AddressLine1", "AddressLine2", "Phone",
    "DateFirstPurchase", "CommuteDistance",
]


def customer_enriched(
    changes: DataFrame,
    person: DataFrame,
    email: DataFrame,
    phone: DataFrame,
    entity_address: DataFrame,
    address: DataFrame,
    education: DataFrame,
    occupation: DataFrame,
) -> DataFrame:
    """Changed customer rows with person, survey, contact and translations.

    A person with several e-mails, phones or addresses takes the one with the
    greatest id or type, so that no join multiplies customers. Only the
    persons in the feed are looked at.
    """
    changes = post_images(changes)
    wanted = changes.select(F.col("person_id").alias("business_entity_id"))
    people = restrict_to_keys(current(person), wanted, ["business_entity_id"])
    surveyed = survey_fields(people, "demographics", SURVEY)
    def contact(rows: DataFrame) -> DataFrame:
        return restrict_to_keys(current(rows), wanted, ["business_entity_id"])

    mail = latest_per_key(contact(email), ["business_entity_id"], ["email_address_id"])
    call = latest_per_key(contact(phone), ["business_entity_id"], ["phone_number_type_id"])
    home = latest_per_key(contact(entity_address), ["business_entity_id"], ["address_type_id"])
    by_person = {"person_id": "business_entity_id"}
    found = star_join(
        changes,
        [
            DimSpec(surveyed, by_person, {**PERSON, **{name: name for name in SURVEY}}),
            DimSpec(mail, by_person, {"EmailAddress": "email_address"}),
            DimSpec(call, by_person, {"Phone": "phone_number"}),
            DimSpec(home, by_person, {"_address_id": "address_id"}),
            DimSpec(
                address,
                {"_address_id": "address_id"},
                {"GeographyKey": "address_id", "AddressLine1": "address_line1", "AddressLine2": "address_line2"},
                current_only=True,
            ),
        ],
    )
    for what, lookup in (("Education", education), ("Occupation", occupation)):
        into = {f"Spanish{what}": "SpanishValue", f"French{what}": "FrenchValue"}
        found = translate(found, f"English{what}", lookup, "EnglishValue", into)
    return found.withColumns(
        {
            "CustomerAlternateKey": F.col("account_number"),
            "DateFirstPurchase": F.col("modified_date"),
        }
    ).select(
        F.col("customer_id").alias("CustomerKey"),
        *ATTRIBUTES,
        F.col("modified_date").alias("valid_from"),
        F.col("end_date").alias("valid_to"),
        "is_current",
        "_commit_version",
    )


def dim_customer_load(
    current_dim: DataFrame,
    history_dim: DataFrame,
    enriched: DataFrame,
    as_of: datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Next states of the dimension and of its history.

    Closed rows go to the history, by customer and start. Of the current rows
    the latest change of each customer is merged; the alternate key is set on
    insert and never updated. ``enriched`` is read several times: pass a staged
    frame where it is expensive.
    """
    stamp = load_stamp(as_of)
    ended = latest_per_key(closed(enriched), ["CustomerKey", "valid_from"], ["_commit_version", "valid_to"])
    valid_to = F.coalesce("valid_to", stamp)
    ended = ended.withColumns(
        {
            "valid_to": valid_to,
            "closed_timestamp": stamp,
            "ingestion_timestamp": stamp,
            "year_valid_to": F.year(valid_to),
        }
    )
    history = insert_if_absent(history_dim, ended, ["CustomerKey", "valid_from"], one_per_key=True)

    live = latest_per_key(current(enriched), ["CustomerKey"], ["_commit_version", "valid_from"])
    update = [c for c in ATTRIBUTES if c != "CustomerAlternateKey"] + ["valid_from", "is_current"]
    merged = merge_upsert(
        current_dim, live, ["CustomerKey"], update, stamp={"ingestion_timestamp": stamp}
    )
    return merged, history
