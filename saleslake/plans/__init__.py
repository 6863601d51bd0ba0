"""Whole layers as one plan each, and the jobs that read, build and write them."""
