"""Lazy DataFrame -> DataFrame operators of the medallion pipeline and its reports."""
