"""Record extractors for the three XML families.

Each extractor is a ``select`` over the struct produced by ``from_xml`` with an
explicit schema: repeatable children are declared as arrays so one and many
occurrences parse alike, and all leaves are text, typed afterwards by the
cleaning rules.  No Python runs per record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas as S
from feedloom.functions import clean as C

STR = T.StringType()


def _struct(names) -> T.StructType:
    return T.StructType([T.StructField(n, STR) for n in dict.fromkeys(names)])


# --------------------------------------------------------------------------- schemas
_HEADER_TAGS = ([t for t, _, _ in S.CASE_HEADER_FIELDS] + [t for t, _ in S.CASE_FLAG_FIELDS]
                + [c.replace("_", "-") for c in S.CASE_FILE_COLUMNS[:-3]])
CASE_FILE_SCHEMA = T.StructType([
    T.StructField("serial-number", STR),
    T.StructField("registration-number", STR),
    T.StructField("case-file-header", _struct(_HEADER_TAGS)),
    T.StructField("international-registration", _struct([t for t, _, _ in S.INTL_REG_FIELDS])),
])

_PARTY_FIELDS = ["person-or-organization-name", "address-1", "address-2", "city", "state", "postcode",
                 "country-name", "execution-date", "date-acknowledged", "legal-entity-text", "nationality"]
ASSIGNMENT_SCHEMA = T.StructType([
    T.StructField("assignment", T.StructType([
        *[T.StructField(n, STR) for n in ["reel-no", "frame-no", "date-recorded", "conveyance-text",
                                          "last-update-date", "purge-indicator", "page-count"]],
        T.StructField("correspondent", _struct(["person-or-organization-name", "address-1", "address-2",
                                                "address-3", "address-4"])),
    ])),
    T.StructField("assignors", T.StructType([T.StructField("assignor", T.ArrayType(_struct(_PARTY_FIELDS)))])),
    T.StructField("assignees", T.StructType([T.StructField("assignee", T.ArrayType(_struct(_PARTY_FIELDS)))])),
    T.StructField("properties", T.StructType([T.StructField("property", T.ArrayType(T.StructType([
        T.StructField("serial-no", STR), T.StructField("registration-no", STR), T.StructField("intl-reg-no", STR),
        T.StructField("trademark-law-treaty-property", _struct(["tlt-mark-name", "tlt-mark-description"])),
    ])))])),
])

_PARTY = T.ArrayType(_struct(["role-code"] + S.PARTY_NAME_TAGS + ["text"]))
PROCEEDING_SCHEMA = T.StructType([
    *[T.StructField(t, STR) for t in dict.fromkeys(
        S.PROCEEDING_NUMBER_TAGS + S.PROCEEDING_TYPE_TAGS + S.PROCEEDING_STATUS_TAGS + S.PROCEEDING_DATE_TAGS
        + S.PROCEEDING_MARK_TAGS + S.PROCEEDING_GOODS_TAGS)],
    T.StructField("party-information", T.StructType([T.StructField("party", _PARTY)])),
    T.StructField("party", _PARTY),
])


def _g(base: Column, *path: str) -> Column:
    c = base
    for p in path:
        c = c.getField(p)
    return c


# --------------------------------------------------------------------------- case files
def case_file_columns(rec: Column, schema_match: bool = True) -> list[Column]:
    """X1 (+X2, +X3): one wide row per case file."""
    hdr = _g(rec, "case-file-header")
    ir = _g(rec, "international-registration")
    out: dict[str, Column] = {
        "serial_no": C.text_or_null(_g(rec, "serial-number")),
        "registration_number": C.no_registration(_g(rec, "registration-number")),
    }
    for tag, name, kind in S.CASE_HEADER_FIELDS:
        v = _g(hdr, tag)
        out[name] = C.yyyymmdd_to_date(v) if kind == "date" else C.text_or_null(v)
    for tag, name in S.CASE_FLAG_FIELDS:
        out[name] = C.xml_flag_bool(_g(hdr, tag))
    for tag, name, kind in S.INTL_REG_FIELDS:
        v = _g(ir, tag)
        out[name] = (C.yyyymmdd_to_date(v) if kind == "date" else
                     C.xml_flag_bool(v) if kind == "flag" else C.text_or_null(v))
    if schema_match:
        # Any header child whose name matches a layout column; X1 values win.
        for col in S.CASE_FILE_COLUMNS[:-3]:
            if col in out:
                continue
            v = _g(hdr, col.replace("_", "-"))
            if col in S.CASE_FILE_DATE_COLUMNS or col.endswith("_dt") or col.endswith("_date"):
                out[col] = C.yyyymmdd_to_date(v)
            elif col.endswith("_in"):
                out[col] = C.xml_flag_bool(v)
            else:
                out[col] = C.text_or_null(v)
    return [v.alias(k) for k, v in out.items()]


def extract_case_files(parsed: DataFrame, product_id: str, schema_match: bool = True,
                       keep: tuple = ("file_path",)) -> DataFrame:
    rec = F.col("rec")
    return parsed.select(*keep, *case_file_columns(rec, schema_match),
                         C.lineage_source(F.lit(product_id), "xml").alias("data_source"),
                         F.col("rec._corrupt_record").alias("_corrupt_record"))


# --------------------------------------------------------------------------- assignments
def _party_cols(p: Column, prefix: str, extended: bool = False) -> dict[str, Column]:
    out = {
        f"{prefix}_name": C.text_or_null(_g(p, "person-or-organization-name")),
        f"{prefix}_address": C.join_present(*[_g(p, t) for t in ("address-1", "address-2", "city", "state",
                                                                  "postcode")]),
    }
    if extended:
        out[f"{prefix}_country"] = C.text_or_null(_g(p, "country-name"))
        out[f"{prefix}_legal_entity"] = C.text_or_null(_g(p, "legal-entity-text"))
        out[f"{prefix}_nationality"] = C.text_or_null(_g(p, "nationality"))
        if prefix == "assignor":
            out["assignor_execution_date"] = C.yyyymmdd_to_date(_g(p, "execution-date"))
            out["assignor_date_acknowledged"] = C.yyyymmdd_to_date(_g(p, "date-acknowledged"))
    return out


def assignment_base(rec: Column, extended: bool = False) -> dict[str, Column]:
    a = _g(rec, "assignment")
    corr = _g(a, "correspondent")
    base = {
        "reel_no": C.text_or_null(_g(a, "reel-no")),
        "frame_no": C.text_or_null(_g(a, "frame-no")),
        "date_recorded": C.yyyymmdd_to_date(_g(a, "date-recorded")),
        "conveyance_text": C.text_or_null(_g(a, "conveyance-text")),
        "last_update_date": C.yyyymmdd_to_date(_g(a, "last-update-date")),
        "purge_indicator": C.text_or_null(_g(a, "purge-indicator")),
        "page_count": C.digits_to_int(_g(a, "page-count")),
        "correspondent_name": C.text_or_null(_g(corr, "person-or-organization-name")),
        "correspondent_address_1": C.text_or_null(_g(corr, "address-1")),
        "correspondent_address_2": C.text_or_null(_g(corr, "address-2")),
        "correspondent_address_3": C.join_present(_g(corr, "address-3"), _g(corr, "address-4")),
    }
    base["assignment_id"] = C.composite_id(_g(a, "reel-no"), _g(a, "frame-no"))
    base.update(_party_cols(F.get(_g(rec, "assignors", "assignor"), 0), "assignor", extended))
    base.update(_party_cols(F.get(_g(rec, "assignees", "assignee"), 0), "assignee", extended))
    return base


def _property_cols(p: Column) -> dict[str, Column]:
    tlt = _g(p, "trademark-law-treaty-property")
    return {
        "serial_no": C.text_or_null(_g(p, "serial-no")),
        "registration_number": C.text_or_null(_g(p, "registration-no")),
        "intl_reg_no": C.text_or_null(_g(p, "intl-reg-no")),
        "tlt_mark_name": C.text_or_null(_g(tlt, "tlt-mark-name")),
        "tlt_mark_description": C.text_or_null(_g(tlt, "tlt-mark-description")),
    }


def assignments_per_property(parsed: DataFrame, product_id: str, keep_empty: bool = False,
                             keep: tuple = ("file_path",)) -> DataFrame:
    """One row per property with the entry's fields repeated; entries without property are
    skipped (``keep_empty`` keeps them once with NULL property fields)."""
    base = assignment_base(F.col("rec"))
    props = _g(F.col("rec"), "properties", "property")
    ex = F.explode_outer(props) if keep_empty else F.explode(props)
    d = parsed.select(*keep, *[v.alias(k) for k, v in base.items()], ex.alias("__p"))
    pc = _property_cols(F.col("__p"))
    return d.select(*keep, *base.keys(), *[v.alias(k) for k, v in pc.items()],
                    C.lineage_source(F.lit(product_id), "xml").alias("data_source"))


def assignments_first(parsed: DataFrame, product_id: str) -> DataFrame:
    """One row per entry: first property, first assignor and assignee, extended party fields."""
    base = assignment_base(F.col("rec"), extended=True)
    pc = _property_cols(F.get(_g(F.col("rec"), "properties", "property"), 0))
    return parsed.select("file_path", *[v.alias(k) for k, v in base.items()],
                         *[v.alias(k) for k, v in pc.items()],
                         F.coalesce(F.size(_g(F.col("rec"), "properties", "property")), F.lit(0))
                         .alias("property_count"),
                         C.lineage_source(F.lit(product_id), "xml").alias("data_source"))


# --------------------------------------------------------------------------- proceedings
def party_by_role(parties: Column, code: str) -> Column:
    """Name of the first party with this role code that has a name (alternatives, then direct text)."""
    def name_of(p):
        return F.coalesce(*[C.text_or_null(p.getField(t)) for t in S.PARTY_NAME_TAGS], C.text_or_null(p.getField("text")))
    hits = F.filter(parties, lambda p: (F.upper(C.strip_ws(p.getField("role-code"))) == code) & name_of(p).isNotNull())
    return name_of(F.get(hits, 0))


def descendant_text(record: Column, tag: str) -> Column:
    """Text of the first element named ``tag`` at any depth of a record, whatever its prefix and case; NULL without text."""
    pattern = rf"(?i)<(?:[\w.-]+:)?{re.escape(tag)}(?:\s[^>]*?)?(?:/>|>([^<]*))"
    text = F.regexp_extract(record, pattern, 1)
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return C.text_or_null(text)


def proceeding_columns(rec: Column, record: Column | None = None) -> list[Column]:
    """With the raw ``record``, fields that are no direct children are found at any depth."""
    def alt(tags):
        own = [_g(rec, t) for t in tags]
        return C.first_present(*own) if record is None else F.coalesce(
            C.first_present(*own), *[descendant_text(record, t) for t in tags])
    parties = F.coalesce(_g(rec, "party-information", "party"), _g(rec, "party"))
    out = {
        "proceeding_number": alt(S.PROCEEDING_NUMBER_TAGS),
        "proceeding_type": alt(S.PROCEEDING_TYPE_TAGS),
        "status": alt(S.PROCEEDING_STATUS_TAGS),
        "filing_date": C.yyyymmdd_to_date(alt(S.PROCEEDING_DATE_TAGS)),
        **{col: party_by_role(parties, code) for code, col in S.PARTY_ROLES},
        "mark_description": alt(S.PROCEEDING_MARK_TAGS),
        "goods_services": C.distinct_merge(*[_g(rec, t) for t in S.PROCEEDING_GOODS_TAGS]),
    }
    return [v.alias(k) for k, v in out.items()]


def extract_proceedings(parsed: DataFrame, product_id: str, keep: tuple = ("file_path",)) -> DataFrame:
    """One row per proceeding."""
    record = F.col("record") if "record" in parsed.columns else None
    return parsed.select(*keep, *proceeding_columns(F.col("rec"), record),
                         C.lineage_source(F.lit(product_id), "xml").alias("data_source"),
                         F.col("rec._corrupt_record").alias("_corrupt_record"))
