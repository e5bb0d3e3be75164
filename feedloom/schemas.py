"""Canonical schemas, alias maps and other fixed values.

FIXED VALUES: the names, tokens and maps in this module must equal the
feed's published layout for results to be right; they are stated here
plainly and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: value tokens used by the cleaning rules
# ---------------------------------------------------------------------------
NULL_TOKENS = ["", "nan", "none", "null"]
TRUE_TOKENS = ["true", "1", "1.0", "yes", "y"]
FALSE_TOKENS = ["false", "0", "0.0", "no", "n"]
EMPTY_DATE_TOKENS = ["", "0000-00-00", "nan"]
NO_REGISTRATION = "0000000"

# Columns converted to whole numbers by name (P10).
INTEGER_NAMES = ["serial_no", "registration_number", "registration_no",
                 "tad_file_id", "cfh_status_cd", "mark_draw_cd"]

# ---------------------------------------------------------------------------
# FIXED VALUES: column alias maps
# ---------------------------------------------------------------------------
# Generic alias map (as published; identity pairs omitted).
GENERIC_ALIASES = {
    "file_location": "file_location_cd",
    "registration_no": "registration_number",
    "serial_number": "serial_no",
    "filing_date": "filing_dt",
    "registration_date": "registration_dt",
    "mark_identification": "mark_id_char",
    "mark_drawing_code": "mark_draw_cd",
    "abandon_date": "abandon_dt",
    "amend_registration_date": "amend_reg_dt",
    "reg_cancel_code": "reg_cancel_cd",
    "reg_cancel_date": "reg_cancel_dt",
    "examiner_attorney_name": "exm_attorney_name",
    "file_location_date": "file_location_dt",
    "publication_date": "publication_dt",
    "renewal_date": "renewal_dt",
    "repub_12c_date": "repub_12c_dt",
    "cfh_status_code": "cfh_status_cd",
    "cfh_status_date": "cfh_status_dt",
    "ir_auto_registration_date": "ir_auto_reg_dt",
    "ir_first_refusal_in": "ir_first_refus_in",
    "ir_death_date": "ir_death_dt",
    "ir_publication_date": "ir_publication_dt",
    "ir_registration_date": "ir_registration_dt",
    "ir_registration_number": "ir_registration_no",
    "ir_renewal_date": "ir_renewal_dt",
    "ir_status_code": "ir_status_cd",
    "ir_status_date": "ir_status_dt",
    "ir_priority_date": "ir_priority_dt",
}

# Case-file CSV map; the column ``file_location`` is dropped.
CASE_FILE_ALIASES = {
    "mark_id_char": "mark_identification",
    "registration_no": "registration_number",
    "filing_dt": "filing_date",
    "registration_dt": "registration_date",
}
CASE_FILE_DROP = ["file_location"]

# Alternate profile: keeps the registration number under ``registration_no``.
ALTERNATE_ALIASES = {
    "serial_number": "serial_no",
    "registration_number": "registration_no",
    "filing_date": "filing_dt",
    "registration_date": "registration_dt",
    "mark_identification": "mark_id_char",
    "mark_drawing_code": "mark_draw_cd",
    "abandon_date": "abandon_dt",
    "amend_registration_date": "amend_reg_dt",
    "reg_cancel_code": "reg_cancel_cd",
    "reg_cancel_date": "reg_cancel_dt",
    "examiner_attorney_name": "exm_attorney_name",
    "file_location_date": "file_location_dt",
    "publication_date": "publication_dt",
    "renewal_date": "renewal_dt",
    "repub_12c_date": "repub_12c_dt",
    "cfh_status_code": "cfh_status_cd",
    "cfh_status_date": "cfh_status_dt",
    "ir_auto_registration_date": "ir_auto_reg_dt",
    "ir_first_refusal_in": "ir_first_refus_in",
    "ir_death_date": "ir_death_dt",
    "ir_publication_date": "ir_publication_dt",
    "ir_registration_date": "ir_registration_dt",
    "ir_registration_number": "ir_registration_no",
    "ir_renewal_date": "ir_renewal_dt",
    "ir_status_code": "ir_status_cd",
    "ir_status_date": "ir_status_dt",
    "ir_priority_date": "ir_priority_dt",
}

# Canonical direction: names of the 82-column case-file layout win.
CANONICAL_ALIASES = {
    **{k: v for k, v in GENERIC_ALIASES.items()
       if k not in ("filing_date", "registration_date", "mark_identification", "mark_drawing_code")},
    **CASE_FILE_ALIASES,
    "mark_draw_cd": "mark_drawing_code",
}

ALIAS_PROFILES = {
    "generic": GENERIC_ALIASES,
    "case_file": CASE_FILE_ALIASES,
    "alternate": ALTERNATE_ALIASES,
    "canonical": CANONICAL_ALIASES,
}

# ---------------------------------------------------------------------------
# FIXED VALUES: case-file layout (79 data columns + 3 lineage columns)
# ---------------------------------------------------------------------------
CASE_FILE_COLUMNS = [
    "serial_no", "registration_number", "filing_date", "registration_date", "status_code",
    "status_date", "mark_identification", "mark_drawing_code", "abandon_dt", "amend_reg_dt",
    "amend_lb_for_app_in", "amend_lb_for_reg_in", "amend_lb_itu_in", "amend_lb_use_in",
    "reg_cancel_cd", "reg_cancel_dt", "cancel_pend_in", "cert_mark_in", "chg_reg_in",
    "coll_memb_mark_in", "coll_serv_mark_in", "coll_trade_mark_in", "draw_color_cur_in",
    "draw_color_file_in", "concur_use_in", "concur_use_pend_in", "draw_3d_cur_in",
    "draw_3d_file_in", "exm_attorney_name", "lb_use_file_in", "lb_for_app_cur_in",
    "lb_for_reg_cur_in", "lb_intl_reg_cur_in", "lb_for_app_file_in", "lb_for_reg_file_in",
    "lb_intl_reg_file_in", "lb_none_cur_in", "for_priority_in", "lb_itu_cur_in",
    "lb_itu_file_in", "interfer_pend_in", "exm_office_cd", "opposit_pend_in",
    "amend_principal_in", "concur_use_pub_in", "publication_dt", "renewal_dt",
    "renewal_file_in", "repub_12c_dt", "repub_12c_in", "incontest_ack_in",
    "incontest_file_in", "acq_dist_in", "acq_dist_part_in", "use_afdv_acc_in",
    "use_afdv_file_in", "use_afdv_par_acc_in", "serv_mark_in", "std_char_claim_in",
    "cfh_status_cd", "cfh_status_dt", "amend_supp_reg_in", "supp_reg_in", "trade_mark_in",
    "lb_use_cur_in", "lb_none_file_in", "ir_auto_reg_dt", "ir_first_refus_in", "ir_death_dt",
    "ir_publication_dt", "ir_registration_dt", "ir_registration_no", "ir_renewal_dt",
    "ir_status_cd", "ir_status_dt", "ir_priority_dt", "ir_priority_in", "related_other_in",
    "tad_file_id", "data_source", "file_hash", "batch_number",
]
# Date columns normalised after the schema-name match.
CASE_FILE_DATE_COLUMNS = [
    "filing_date", "registration_date", "status_date", "publication_dt", "renewal_dt",
    "cfh_status_dt", "reg_cancel_dt", "repub_12c_dt", "ir_registration_dt", "ir_renewal_dt",
    "ir_publication_dt", "ir_status_dt", "ir_priority_dt", "ir_death_dt", "ir_auto_reg_dt",
    "last_update_date",
]

# Case-file header tags -> columns.
CASE_HEADER_FIELDS = [
    ("filing-date", "filing_date", "date"),
    ("registration-date", "registration_date", "date"),
    ("status-code", "status_code", "text"),
    ("status-date", "status_date", "date"),
    ("mark-identification", "mark_identification", "text"),
    ("mark-drawing-code", "mark_drawing_code", "text"),
    ("published-for-opposition-date", "publication_dt", "date"),
    ("renewal-date", "renewal_dt", "date"),
    ("law-office-assigned-location-code", "exm_office_cd", "text"),
]

# Case-file header flag tags -> columns (X1, rule P20).
CASE_FLAG_FIELDS = [
    ("trademark-in", "trade_mark_in"),
    ("collective-trademark-in", "coll_trade_mark_in"),
    ("service-mark-in", "serv_mark_in"),
    ("collective-service-mark-in", "coll_serv_mark_in"),
    ("collective-membership-mark-in", "coll_memb_mark_in"),
    ("certification-mark-in", "cert_mark_in"),
    ("cancellation-pending-in", "cancel_pend_in"),
    ("published-concurrent-in", "concur_use_pub_in"),
    ("concurrent-use-in", "concur_use_in"),
    ("concurrent-use-proceeding-in", "concur_use_pend_in"),
    ("interference-pending-in", "interfer_pend_in"),
    ("opposition-pending-in", "opposit_pend_in"),
    ("section-12c-in", "repub_12c_in"),
    ("standard-characters-claimed-in", "std_char_claim_in"),
    ("foreign-priority-in", "for_priority_in"),
    ("intent-to-use-in", "lb_itu_file_in"),
    ("intent-to-use-current-in", "lb_itu_cur_in"),
    ("filed-as-use-application-in", "lb_use_file_in"),
    ("use-application-currently-in", "lb_use_cur_in"),
    ("supplemental-register-amended-in", "amend_supp_reg_in"),
    ("supplemental-register-in", "supp_reg_in"),
    ("principal-register-amended-in", "amend_principal_in"),
    ("renewal-filed-in", "renewal_file_in"),
    ("color-drawing-filed-in", "draw_color_file_in"),
    ("color-drawing-current-in", "draw_color_cur_in"),
    ("drawing-3d-filed-in", "draw_3d_file_in"),
    ("drawing-3d-current-in", "draw_3d_cur_in"),
]

# International-registration block tags -> columns.
INTL_REG_FIELDS = [
    ("international-registration-number", "ir_registration_no", "text"),
    ("international-registration-date", "ir_registration_dt", "date"),
    ("international-publication-date", "ir_publication_dt", "date"),
    ("international-renewal-date", "ir_renewal_dt", "date"),
    ("auto-protection-date", "ir_auto_reg_dt", "date"),
    ("international-status-code", "ir_status_cd", "text"),
    ("international-status-date", "ir_status_dt", "date"),
    ("priority-claimed-date", "ir_priority_dt", "date"),
    ("priority-claimed-in", "ir_priority_in", "flag"),
    ("first-refusal-in", "ir_first_refus_in", "flag"),
]

# Proceeding alternatives (X6), first non-empty wins, in this order.
PROCEEDING_NUMBER_TAGS = ["proceeding-number", "number"]
PROCEEDING_TYPE_TAGS = ["proceeding-type", "proceeding-type-code", "type-code"]
PROCEEDING_STATUS_TAGS = ["status", "status-code"]
PROCEEDING_DATE_TAGS = ["filing-date", "filed-date"]
PROCEEDING_MARK_TAGS = ["mark-identification", "mark-text", "mark-description"]
PROCEEDING_GOODS_TAGS = ["goods-services", "goods-and-services", "gs-text", "goods", "services"]
PARTY_NAME_TAGS = ["name", "party-name", "person-or-organization-name"]
# Role code -> column; P: applicant, D: opposer.
PARTY_ROLES = [("P", "applicant_name"), ("D", "opposer_name")]

# ---------------------------------------------------------------------------
# FIXED VALUES: product catalogue, families and record tags
# ---------------------------------------------------------------------------
PRODUCT_FAMILY = {
    "TRCFECO2": "case_file", "TRTDXFAP": "case_file", "TRTYRAP": "case_file",
    "TRASECO": "assignment", "TRTDXFAG": "assignment", "TRTYRAG": "assignment",
    "TTABTDXF": "proceeding", "TTABYR": "proceeding",
}
RECORD_TAGS = {
    "assignment": ["assignment-entry"],
    "case_file": ["case-file", "trademark-application"],
    "proceeding": ["proceeding-entry", "proceeding", "ttab-proceeding"],
    "generic": ["record", "item"],
}
# Element whose innermost parent is the record in files without a known tag.
FALLBACK_MARKERS = {"proceeding": "proceeding-number"}
# Sample-record tag patterns, tried in this order (Q7).
SAMPLE_TAG_PATTERNS = ["record", "application", "assignment", "proceeding", "trademark"]

# Archive main-member priority (S8): first matching pattern wins.
MAIN_MEMBER_PATTERNS = [r"\.csv$", r"\.xml$", r"\.dta$", r"^case_file", r"^assignment", r"^proceeding"]
DOC_EXTENSIONS = [".pdf", ".doc", ".txt"]

# Data-file discovery.
DATA_EXTENSIONS = [".csv", ".xml", ".dta", ".zip"]
EXCLUDED_PATTERNS = [".tmp", ".temp", ".log", ".bak"]

# Common primary-key names, in preference order (Q1).
KEY_CANDIDATES = ["serial_no", "serial_number", "registration_number", "id", "record_id"]
PREFERRED_KEY_BY_FAMILY = {"case_file": "serial_no", "assignment": "assignment_id",
                           "proceeding": "proceeding_number"}

# Family markers, tested in this order (Q3; assignment before case).
FAMILY_MARKERS = [("raw_data", "generic"), ("assignment_id", "assignment"),
                  ("registration_number", "case_file"), ("proceeding_number", "proceeding")]

# Out-of-range key screen thresholds.
SCREEN_LOW = 60000000
SCREEN_BAND = (60000001, 69999999)
SCREEN_THRESHOLDS = [60000001, 70000000, 80000000]

# ---------------------------------------------------------------------------
# Control tables
# ---------------------------------------------------------------------------
PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("from_date", T.StringType()),
    T.StructField("to_date", T.StringType()),
    T.StructField("total_size", T.LongType()),
    T.StructField("file_count", T.LongType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("formats", T.ArrayType(T.StringType())),
    T.StructField("table_name", T.StringType()),
    T.StructField("schema_created", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

FILE_HISTORY_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("file_url", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("download_date", T.TimestampNTZType()),
    T.StructField("processing_started", T.TimestampNTZType()),
    T.StructField("processing_completed", T.TimestampNTZType()),
    T.StructField("rows_processed", T.LongType()),
    T.StructField("rows_saved", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("processing_attempts", T.LongType()),
    T.StructField("batch_count", T.LongType()),
    T.StructField("last_batch_processed", T.LongType()),
])

BATCH_HISTORY_SCHEMA = T.StructType([
    T.StructField("product_id", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("batch_number", T.LongType(), False),
    T.StructField("batch_file_path", T.StringType()),
    T.StructField("rows_in_batch", T.LongType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("saved_to_db", T.BooleanType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("processed_at", T.TimestampNTZType()),
])

STATUSES = ["pending", "processing", "completed", "error"]

# FIXED VALUES: configured (documented, not coded) operating limits.
KEEP_LATEST_ARCHIVES = 10
MAX_ERRORS_PER_FILE = 100
MAX_ERRORS_PER_BATCH = 50
ERROR_RATE_ALERT_PCT = 5
ERROR_MESSAGE_MAX = 1000

# Typed family layouts used by ``conform`` (K11).  Text unless listed.
ASSIGNMENT_TYPES = {
    "assignment_id": "string", "reel_no": "string", "frame_no": "string",
    "date_recorded": "date", "conveyance_text": "string", "last_update_date": "date",
    "purge_indicator": "string", "page_count": "int", "correspondent_name": "string",
    "correspondent_address_1": "string", "correspondent_address_2": "string",
    "correspondent_address_3": "string", "assignor_name": "string",
    "assignor_address": "string", "assignee_name": "string", "assignee_address": "string",
    "serial_no": "string", "registration_number": "string", "intl_reg_no": "string",
    "tlt_mark_name": "string", "tlt_mark_description": "string",
}
PROCEEDING_TYPES = {
    "proceeding_number": "string", "proceeding_type": "string", "status": "string",
    "filing_date": "date", "applicant_name": "string", "opposer_name": "string",
    "mark_description": "string", "goods_services": "string",
}
LENGTH_LIMITS = {"serial_no": 20, "registration_number": 20, "status_code": 10,
                 "purge_indicator": 1, "proceeding_number": 20}


def family_types(family: str) -> dict[str, str]:
    """The columns of a family's table and their types.  Keys and codes are text, so leading zeros stay."""
    if family == "assignment":
        return ASSIGNMENT_TYPES
    if family == "proceeding":
        return PROCEEDING_TYPES
    lineage = ("data_source", "file_hash", "batch_number")
    return {c: "date" if c in CASE_FILE_DATE_COLUMNS or c.endswith(("_dt", "_date")) else "boolean" if c.endswith("_in") else "string"
            for c in CASE_FILE_COLUMNS if c not in lineage}
