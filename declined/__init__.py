"""Audit of orders whose payment was refused although the fraud check found it legitimate."""
