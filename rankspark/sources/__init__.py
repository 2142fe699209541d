"""Readers for file trees and for separator-delimited record files."""
