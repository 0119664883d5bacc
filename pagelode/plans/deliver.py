"""The four files that go out: the master, the addresses to verify, the rows to review and the branches.

Each is a projection of rows that the operators made; the column lists are fixed values, in the order in which they are written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelode.functions.text import title_case
from pagelode.operators.contacts import emails_found, people_for
from pagelode.sources.csvio import joined, write_csv

GUESSES = tuple(f"guessed_email_{i}" for i in range(1, 7))
MASTER_COLUMNS = (
    "facility_name", "website", "city", "state", "facility_type", "sports_offered", "indoor_court_status", "number_of_courts", "court_count_notes", "decision_maker_first_name", "decision_maker_last_name",
    "decision_maker_title", "public_direct_email", "shared_facility_email", *GUESSES, "email_domain", "qualification_status", "research_notes", "source_urls",
)
CANDIDATE_COLUMNS = (
    "facility_id", "facility_name", "website", "city", "state", "facility_type", "sports_offered", "indoor_court_status", "number_of_courts", "decision_maker_first_name", "decision_maker_last_name",
    "decision_maker_full_name", "decision_maker_title", "company_domain", "candidate_email", "email_candidate_type", "pattern_rank", "email_source_url", "facility_source_urls", "qualification_notes",
)
REVIEW_COLUMNS = (
    "facility_id", "facility_name", "website", "city", "state", "facility_type", "sports_offered", "indoor_court_status", "qualification_status", "indoor_evidence", "number_of_courts", "court_count_notes",
    "decision_maker_first_name", "decision_maker_last_name", "decision_maker_full_name", "decision_maker_title", "company_domain", "published_direct_email", "shared_facility_email", *GUESSES,
    "emails_found", "research_notes", "source_urls",
)
LOCATION_COLUMNS = (
    "facility_id", "location_id", "facility_name", "branch_street", "branch_city", "branch_zip", "state", "website", "company_domain", "indoor_court_status", "qualification_status", "is_multi_location",
    "location_count", "source_urls",
)
EVIDENCE = "Court sport confirmed on the facility site; no explicit indoor or outdoor statement found on the crawled pages. Needs a human check of the website or a call before outreach."
PUBLISHED = "Published on the facility website - UNVERIFIED until Reoon confirms deliverability."
GUESSED = "GUESSED PATTERN - not a published address; unverified permutation of the confirmed name against the company domain."


def title_of(column: str) -> str:
    """Heading of a column: its words with capitals, the short ones in capitals throughout."""
    return " ".join({"id": "ID", "urls": "URLs", "url": "URL", "zip": "ZIP", "of": "of"}.get(w, w.capitalize()) for w in column.split("_"))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def _shared(rows: DataFrame) -> DataFrame:
    """Arrays as one cell each; state under its own name."""
    rows = rows.withColumns({"sports_offered": joined("sports_offered", "; "), "source_urls": joined("source_urls", " | ")})
    return rows if "state" in rows.columns else rows.withColumn("state", F.col("state_code"))


def master_rows(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _shared(rows).select(*keep, *[_text(c).alias(c) for c in MASTER_COLUMNS])


def candidate_rows(won: DataFrame, n_locations: Column) -> DataFrame:
    """Rows of fan_out_candidates as they are verified. A published address has the site as its source, a guess has none."""
    n = F.coalesce(n_locations, F.lit(0))
    multi = F.when(n > 1, F.concat(F.lit("Multi-location operator ("), n.cast("string"), F.lit(" "), _text("state"), F.lit(" branches; see locations CSV)")))
    notes = F.concat(F.concat_ws(". ", F.when(_text("qualification_status") != "", F.col("qualification_status")), multi, F.when(F.col("published"), PUBLISHED).otherwise(GUESSED)), F.lit("."))
    made = {
        "decision_maker_title": F.col("title"), "company_domain": F.col("email_domain"), "candidate_email": F.col("email"), "email_candidate_type": F.col("type"), "pattern_rank": F.col("rank"),
        "email_source_url": F.when(F.col("published"), F.col("website")), "facility_source_urls": F.col("source_urls"), "qualification_notes": notes,
    }
    return _shared(won).withColumns(made).select(*[_text(c).alias(c) for c in CANDIDATE_COLUMNS])


def review_rows(facilities: DataFrame, known_mails: Column | None = None) -> DataFrame:
    """Facilities parked for review, with the first of their people and all that was found of them."""
    p = F.get(people_for(), F.lit(0))
    rows = _shared(facilities).withColumns({"emails_found": emails_found(known_mails), "__p": p})
    first, last = title_case("__p.first"), title_case("__p.last")
    made = {
        "indoor_evidence": F.lit(EVIDENCE), "decision_maker_first_name": first, "decision_maker_last_name": last, "decision_maker_title": F.col("__p.title"), "company_domain": F.col("email_domain"),
        "published_direct_email": F.col("public_direct_email"), "decision_maker_full_name": F.concat_ws(" ", F.nullif(first, F.lit("")), F.nullif(last, F.lit(""))),
    }
    return rows.withColumns(made).select(*[_text(c).alias(c) for c in REVIEW_COLUMNS])


def location_sites(facilities: DataFrame) -> DataFrame:
    """Facilities with their own columns of location_rows as text: made once a facility, not once a branch, of which a chain has very many."""
    rows = _shared(facilities).withColumn("company_domain", F.col("email_domain"))
    own = [c for c in LOCATION_COLUMNS if c in rows.columns]
    return rows.select(*[_text(c).alias(c) for c in own], "city", "extras_website", "n_locations")


def location_rows(branch: DataFrame) -> DataFrame:
    """Branches of location_sites as they are written."""
    return branch.select(*[_text(c).alias(c) for c in LOCATION_COLUMNS])


def write(rows: DataFrame, path: str) -> None:
    """One of the four as CSV part files with their headings."""
    write_csv(rows, path, rows.columns, [title_of(c) for c in rows.columns])
