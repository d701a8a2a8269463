"""Texts and notices of public licences (fixed values)."""

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""

_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_0BSD_GRANT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted."""

_BSD_START = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""

_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its
contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""

_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be
appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.

In jurisdictions that recognize copyright laws, the author or authors
of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit
of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND,
EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR
OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def _joined(*parts: str) -> str:
    return "\n\n".join(parts)


# (licence, whole text); titles may be there or not.
TEXTS = (
    ("MIT", _MIT_GRANT),
    ("MIT", _joined("MIT License", _MIT_GRANT)),
    ("MIT", _joined("The MIT License (MIT)", _MIT_GRANT)),
    ("ISC", _joined(_ISC_GRANT, _ISC_WARRANTY)),
    ("ISC", _joined("ISC License", _ISC_GRANT, _ISC_WARRANTY)),
    ("0BSD", _joined(_0BSD_GRANT, _ISC_WARRANTY)),
    ("0BSD", _joined("Zero-Clause BSD", _0BSD_GRANT, _ISC_WARRANTY)),
    ("BSD-2-Clause", _joined(_BSD_START, _BSD_WARRANTY)),
    ("BSD-2-Clause", _joined("BSD 2-Clause License", _BSD_START, _BSD_WARRANTY)),
    ("BSD-3-Clause", _joined(_BSD_START, _BSD_THIRD, _BSD_WARRANTY)),
    ("BSD-3-Clause", _joined("BSD 3-Clause License", _BSD_START, _BSD_THIRD, _BSD_WARRANTY)),
    ("Zlib", _ZLIB),
    ("Zlib", _joined("zlib License", _ZLIB)),
    ("Unlicense", _UNLICENSE),
    ("Apache-2.0", _APACHE_HEADER),
)

# (licence, a line that says a text is under it)
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
)

# Spellings that count as the same, after case and punctuation are gone.
SPELLINGS = (
    ("licence", "license"),
    ("licencing", "licensing"),
    ("sub license", "sublicense"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("organis", "organiz"),
    ("recognis", "recogniz"),
    ("authoris", "authoriz"),
    ("utilis", "utiliz"),
    ("initialis", "initializ"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("merchantibility", "merchantability"),
    ("non infringement", "noninfringement"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("programme", "program"),
    ("whilst", "while"),
    ("fulfilment", "fulfillment"),
    ("labour", "labor"),
    ("behaviour", "behavior"),
    ("catalogue", "catalog"),
    ("analyse", "analyze"),
    ("copyright owner", "copyright holder"),
    ("http www", "https www"),
)

# (licence, digest of the canonical form of its text), for long texts that are not kept here; with and
# without what follows the end of the terms.
DIGESTS = (
    ("Apache-2.0", "4a6318c7afd8feed8c4463ea5ae0f2f609d433928a8b17f31104c8e7743de2c5"),
    ("Apache-2.0", "b93faad605f4e5d56d92cb01789c993887913c893e441b2305b4f880a9cead93"),
    ("Apache-2.0", "4d82b1bff1ec74deb3a29bbe890a43fcd5d6d11ae4b24b20d2c0ef74a1b12809"),
    ("GPL-1.0", "98db0b473e0a45a62b04a39b6b864b4e079a58d513e2196f94fe7252fa8574a6"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "e95eb1718f9f373d56cc586a5f7d1bfa11668867f6e85e982d2b6108b97d90a1"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "df71f3c423c11bc52456a9775329f1d9a3168a6f071654750b9eb155fb3ec0eb"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "e4deecd0730802431ad09f00ae3793f3703c8e4dba639586545d9f958405614d"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "d3826e4e563a04a354453ff139a32b19d6c3fe283f518eb566107c54e18cd01f"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986"),
    ("MPL-2.0", "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e"),
    ("GFDL-1.2", "1c057ea35084eb195331cec1a49fca335c176422a7726a9a23636906fd4e241f"),
    ("GFDL-1.3", "7e8edd3abe6258bb82bb853d91a0c24fcd9976894fd0592747354cffe1cb18e7"),
)
