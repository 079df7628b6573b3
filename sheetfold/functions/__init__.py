"""Column functions (see :mod:`sheetfold.functions.text`)."""

from sheetfold.functions import text

__all__ = ["text"]
