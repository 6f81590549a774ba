"""Error codes and nested messages of job attempts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Database error codes by class, and codes worth a retry.
ERROR_CLASSES = {
    "missing_object": [208],
    "permission_denied": [229, 230],
    "login_failed": [18456],
    "timeout": [-2, 258],
    "deadlock": [1205],
    "null_not_allowed": [515],
    "constraint_violation": [547],
}
TRANSIENT_CODES = [-2, 258, 1205, 4060, 40197, 40501, 40613]

# Texts of wrapper errors that carry no information, and the text used when
# nothing else is left.
WRAPPER_TEXTS = ["One or more errors occurred", "See the inner exception for details"]
UNKNOWN_ERROR = "An unknown error occurred."

NOT_A_DATABASE_ERROR = 0  # code of a failure outside the database; its message stands for itself

# What a user reads for each class; "{}" takes the original message.
CLASS_MESSAGES = {
    "missing_object": "A table or view used by the job was not found; check its staging table. {}",
    "permission_denied": "The login may not use an object of the job. {}",
    "login_failed": "The database refused the login.",
    "timeout": "The job ran out of time; use a narrower range or try later.",
    "deadlock": "The job lost a deadlock; run it again.",
    "null_not_allowed": "A required column is NULL. {}",
    "constraint_violation": "A constraint was violated. {}",
}


def error_class(code: Column) -> Column:
    chain = F.when(code.isNull(), F.lit(None).cast("string"))
    for name, codes in ERROR_CLASSES.items():
        chain = chain.when(code.isin(codes), name)
    return chain.otherwise("other")


def error_message(code: Column, detail: Column) -> Column:
    chain = F.when(code.isNull(), F.lit(None).cast("string")).when(code == NOT_A_DATABASE_ERROR, detail)
    for name, codes in ERROR_CLASSES.items():
        chain = chain.when(code.isin(codes), F.replace(F.lit(CLASS_MESSAGES[name]), F.lit("{}"), detail))
    return chain.otherwise(F.concat(F.lit("Database error ("), code.cast("string"), F.lit("): "), detail))


def is_transient(code: Column) -> Column:
    return code.isin(TRANSIENT_CODES)


def collapse_messages(messages: Column) -> Column:
    """Outermost-first error messages as one line: trimmed, each once, wrappers left out."""
    trimmed = F.transform(messages, lambda m: F.regexp_replace(m, r"^\s+|\s+$", ""))
    told = F.filter(trimmed, lambda m: ~m.rlike("|".join(WRAPPER_TEXTS)))
    line = F.array_join(F.array_distinct(told), " — ")
    return F.when(F.size(told) > 0, line).otherwise(F.lit(UNKNOWN_ERROR))
