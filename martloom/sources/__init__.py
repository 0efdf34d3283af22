"""Readers for landing files and configuration."""
