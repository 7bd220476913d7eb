"""Readers: folders of files, tables, stored chunk documents and vectors."""
