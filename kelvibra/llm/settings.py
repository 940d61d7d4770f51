"""Production parameters of the registered queries."""

from __future__ import annotations

import os

# rows of whole texts that go to a Python worker at once
BATCH_ROWS = 1_000

# where the vocabulary files of public tokenizers lie
TOKENIZERS = os.environ.get("KELVIBRA_TOKENIZERS", "/opt/tokenizers")
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"

# fixed values: the rules of the URL query
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# fixed values: domains whose hosts the URL query's list holds
LISTED_NAMES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_DOMAINS = tuple(f"{name}.example.{end}" for name in LISTED_NAMES for end in ("com", "net", "org"))

# fixed values: public license notices, and passages of the licenses themselves
LICENSES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License. You may obtain a copy of the License at",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
           "that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "General Public License as published by the Free Software Foundation",
    "MIT": "Released under the MIT License.",
    "MIT permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files, to deal in the Software without restriction",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "AGPL notice": 
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "Affero General Public License as published by the Free Software Foundation",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "AGPL-3.0 body": 
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of "
        "works, specifically designed to ensure cooperation with the community in the case of network server "
        "software.",
    "All rights reserved": "All rights reserved.",
    "Apache-2.0 body": 
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a "
        "perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to "
        "reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and "
        "distribute the Work and such Derivative Works in Source or Object form.",
    "Apache-2.0 terms": 
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or '
        "implied. See the License for the specific language governing permissions and limitations under the "
        "License.",
    "BSD body": 
        "Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    "CC0-1.0": 
        "To the extent possible under law, the author has waived all copyright and related or neighboring "
        "rights to this work.",
    "CC0-1.0 body": 
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and "
        'Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an "owner") '
        'of an original work of authorship and/or a database (each, a "Work").',
    "GPL body": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 body": 
        "The licenses for most software are designed to take away your freedom to share and change it. By "
        "contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
        "free software--to make sure the software is free for all its users.",
    "GPL-2.0 notice": 
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the "
        "License, or (at your option) any later version.",
    "GPL-3.0 body": 
        "The licenses for most software and other practical works are designed to take away your freedom to "
        "share and change the works. By contrast, the GNU General Public License is intended to guarantee "
        "your freedom to share and change all versions of a program--to make sure it remains free software "
        "for all its users.",
    "GPL-3.0 notice": 
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the "
        "License, or (at your option) any later version.",
    "ISC": 
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
        "copies.",
    "LGPL notice": 
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
    "LGPL-2.0 notice":
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Library General Public License as published by the Free Software Foundation",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 body": 
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of "
        "version 3 of the GNU General Public License, supplemented by the additional permissions listed "
        "below.",
    "MIT body": 
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    "MPL-2.0 body": 
        "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license under "
        "intellectual property rights (other than patent or trademark) Licensable by such Contributor to use, "
        "reproduce, make available, modify, display, perform, distribute, and otherwise exploit its "
        "Contributions",
    "Unlicense": 
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
