"""Fiscal XML documents to fixed-layout header, item and partner tables, on Spark."""

from fiscalmill.settings import Settings

__all__ = ["Settings"]
