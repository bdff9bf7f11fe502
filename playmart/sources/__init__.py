"""Readers: raw JSON trees and the parquet test tables."""
