"""Landed files in, staging and mart tables out."""
