"""Readers for landed listing pages, payloads, messages and stored documents."""
