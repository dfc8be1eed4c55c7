"""Continuous forms of reports that are otherwise polled."""
