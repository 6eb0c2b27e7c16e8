"""Readers. Every reader declares its schema; none infers one."""
