"""Everything that is specific to one review site, in one place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    """Names and addresses of the site whose pages were saved."""

    base_url: str = "https://books.example.org"
    search_path: str = "/search"
    review_path: str = "/review/show/"
    url_column: str = "book_url"
    reviews_per_page: int = 30

    @property
    def search_url(self) -> str:
        return self.base_url + self.search_path


DEFAULT_SITE = Site()
