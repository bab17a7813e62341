"""Registered queries over the driver's tables, each with an independent SQL statement where SQL can
express the operator."""
