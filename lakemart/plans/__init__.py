"""Admission marts: the layers stg, dw, int, gen and pub as models."""
