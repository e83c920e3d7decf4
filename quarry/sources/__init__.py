"""Readers: basket files and fact tables, labelled records, point sets, saved results."""
