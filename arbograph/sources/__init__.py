"""Inventories, directory trees and side documents."""
