"""Schemas of the stored tables and the fixed code tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I, _D, _B, _DATE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.DateType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Exactly one of (low and high) and exact is set.
AMOUNT = _struct(low=_L, high=_L, exact=_D, label=_S)
FILER = _struct(prefix=_S, first=_S, last=_S, suffix=_S)
STATE_DISTRICT = _struct(raw=_S, state=_S, district=_I)
FILING_TYPE = _struct(code=_S, label=_S)

FILINGS = _struct(
    doc_id=_S, year=_I, filer=FILER, filer_id=_S, bioguide_id=_S, state_district=STATE_DISTRICT, filing_type=FILING_TYPE,
    filing_date=_DATE, source_pdf=_S, pdf_class=_S, parse_status=_S,
)
TRANSACTION = _struct(
    owner=_S, asset=_S, ticker=_S, asset_type=_S, asset_type_raw=_S, transaction_type=_S, transaction_date=_DATE, date_raw=_S,
    notification_date=_DATE, notification_date_raw=_S, amount_range=AMOUNT, cap_gains_over_200=_B, description=_S,
)
PTR_BODY = _struct(transactions=T.ArrayType(TRANSACTION))
SCHEDULES = {
    "A": _struct(asset=_S, owner=_S, asset_type=_S, asset_type_raw=_S, value_of_asset=AMOUNT, income_type=_S, income_amount=AMOUNT, income_preceding=AMOUNT, location=_S, description=_S, raw_text=_S),
    "B": _struct(asset=_S, owner=_S, asset_type=_S, asset_type_raw=_S, transaction_date=_DATE, transaction_date_raw=_S, transaction_type=_S, amount_range=AMOUNT, cap_gains_over_200=_B, raw_text=_S),
    "C": _struct(source=_S, income_type=_S, amount=_S, amount_preceding=_S, raw_text=_S),
    "D": _struct(creditor=_S, owner=_S, date_incurred=_S, liability_type=_S, amount_range=AMOUNT, raw_text=_S),
    "E": _struct(position=_S, organization=_S, raw_text=_S),
    "F": _struct(date=_S, parties=_S, terms=_S, raw_text=_S),
    "G": _struct(source=_S, description=_S, value=_S, raw_text=_S),
    "H": _struct(source=_S, dates=_S, location=_S, items=_S, raw_text=_S),
    "I": _struct(source=_S, activity=_S, date=_S, amount=_S, raw_text=_S),
    "J": _struct(source=_S, description=_S, raw_text=_S),
}
FD_BODY = _struct(schedules=T.StructType([T.StructField(k, T.ArrayType(v)) for k, v in SCHEDULES.items()]))
LEGISLATORS = _struct(id=_struct(bioguide=_S, fec=T.ArrayType(_S)), name=_struct(first=_S, last=_S, official_full=_S), terms=T.ArrayType(_struct(type=_S, state=_S, district=_I, start=_DATE)))
COMMITTEES = _struct(committee_id=_S, name=_S, connected_organization_name=_S, organization_type=_S, organization_type_raw=_S, committee_type=_S, affiliation=_S, provenance=_S)
CONTRIBUTIONS = _struct(recipient_committee_id=_S, contributor_committee_id=_S, amount=_D, date=_DATE, line=_S, image_number=_S, transaction_id=_S, provenance=_S)
MEMBER_LINKS = _struct(bioguide_id=_S, candidate_id=_S, committee_id=_S, provenance=_S)
INDEPENDENT_EXPENDITURES = _struct(
    spender_committee_id=_S, spender_name=_S, connected_organization_name=_S, candidate_id=_S, bioguide_id=_S, office=_S,
    support_oppose=_S, support_oppose_raw=_S, amount=_D, date=_DATE, purpose=_S, image_number=_S, transaction_id=_S, provenance=_S,
)
COMMITTEE_DEFINITIONS = _struct(type=_S, name=_S, thomas_id=_S, congresses=T.ArrayType(_I), subcommittees=T.ArrayType(_struct(name=_S, thomas_id=_S)))
MEMBERSHIP = T.MapType(_S, T.ArrayType(_struct(name=_S, party=_S, rank=_I, title=_S, bioguide=_S)))
VERDICTS = _struct(
    doc_id=_S, is_fully_precise=_B, is_fully_recalled=_B, n_incorrect_entries=_I, n_missing_entries=_I, is_metadata_accurate=_B,
    is_metadata_fully_complete=_B, snapshot=_S, note=_S,
)

# Versions of the stored forms; readers warn when they meet another one.
FILINGS_VERSION, MONEY_VERSION, LABELS_VERSION = 11, 2, 1

# Filing types.
FILING_TYPES = {
    "C": "candidate_report", "X": "extension", "P": "periodic_transaction_report", "O": "annual_report", "A": "amendment",
    "D": "unknown_d", "W": "withdrawal", "H": "unknown_h", "T": "termination", "B": "unknown_b", "G": "unknown_g", "E": "unknown_e",
}
UNKNOWN_FILING = "unknown"
PTR_TYPE, CANDIDATE_TYPE = "P", "C"
ANNUAL_TYPES = ("O", "A")

# Organisations behind connected committees, and directions of independent expenditures.
ORGANISATIONS = {"C": "corporation", "T": "trade", "L": "labor", "M": "membership", "V": "cooperative", "W": "corporation_without_capital_stock"}
DIRECTIONS = {"S": "support", "O": "oppose"}
PROVENANCE, PROVENANCE_IE = "fec", "fec_ie"
CONTRIBUTION_LINE = "F3-11C"
CYCLE_LIMIT = 10_000

# Reasons of residuals, in order of display.
IDENTITY_REASONS = ("candidate", "no_district", "unknown_seat", "ambiguous_seat", "suspicious")
IDENTITY_PRIORITY = ("suspicious", "ambiguous_seat", "unknown_seat", "candidate", "no_district")
FILING_REASONS = ("scanned", "missing", "extract_failed", "unknown_type", "date_out_of_range", "schedule_incomplete")
CONTRIBUTION_REASONS = ("unresolved_committee", "not_connected_ssf", "malformed_short_row")
EXPENDITURE_REASONS = ("not_house_candidate", "unresolved_candidate", "malformed_short_row")
LINK_REASONS = ("no_principal_committee", "no_fec_id")
TICKERED_TYPES = ("ST", "OP")
