"""Topic names of the jobs, and which topics each downstream job reads."""

from __future__ import annotations

from cardweave.schemas import JOB_MESSAGE_TYPE

PREFIX = "cards"


def _words(job: str) -> str:
    return job.replace("_", ".")


def request_topic(job: str) -> str:
    return f"{PREFIX}.{_words(job)}.request"


def response_topic(job: str) -> str:
    return f"{PREFIX}.{_words(job)}.response"


def error_topic(job: str) -> str:
    return f"{PREFIX}.{_words(job)}.error"


REQUEST_JOBS = tuple(JOB_MESSAGE_TYPE)

# downstream job -> request jobs whose responses it reads
DOWNSTREAM = {
    "save_history": REQUEST_JOBS,
    "total_spend": ("authorisation", "externally_authorised", "presentment"),
    "earmarking": ("authorisation", "externally_authorised", "authorisation_reversal",
                   "presentment"),
    "accounting": ("presentment", "financial_reversal", "chargeback", "second_presentment"),
}

RESULT_TOPIC = {
    "save_history": f"{PREFIX}.message.processed.saved",
    "total_spend": f"{PREFIX}.total.spend.updated",
    "earmarking": f"{PREFIX}.earmarking.completed",
    "accounting": f"{PREFIX}.accounting.completed",
}

# Event names of the results.
EVENT_NAME = {
    "request": "RESPONSE_MESSAGE",
    "save_history": "MESSAGE_SAVED",
    "total_spend": "TOTAL_SPEND_UPDATED",
    "earmarking": "EARMARKING_COMPLETED",
    "accounting": "ACCOUNTING_COMPLETED",
}
